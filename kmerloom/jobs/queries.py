"""Registered queries over the star schema and ``documents``, each with DuckDB SQL for the same rows.

``documents`` stands in for sequencing reads: whole texts are projected onto bases, a language and a source make a
sample, English is group 1. P-values are compared as rounded logarithms, since the smallest would round to zero.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing, sequences, signatures, sql, statistics
from ..operators import assembly, counting, lookup, matrix, presence, report, superkmers
from ..sources import count_store, manifest
from ..sources.reads import document_reads
from ..storage import scratch
from ..streaming import cohort

K = 7
LONG_K = 12
MIN_COUNT = 2
P_CUT = 0.01

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# SQL text that the queries share.

_ONTO = "".join("ACGT"[i % 4] for i in range(26)) + "N"
_ROWS = "SELECT doc_id AS read_id, CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS grp, lang || '-' || source AS sample,"
_KNOWN = "FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL"
# Letters only, so that long k-mers do not end with each word.
JOINED = f"""reads AS ({_ROWS} translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', '{_ONTO[:26]}') AS seq {_KNOWN})"""
READS = f"""reads AS ({_ROWS} translate(lower(regexp_replace(text, '[^A-Za-z]', '-', 'g')), 'abcdefghijklmnopqrstuvwxyz-', '{_ONTO}') AS seq {_KNOWN})"""


def _windows(k: int) -> str:
    return f"{JOINED if k >= LONG_K else READS}, windows AS (SELECT read_id, grp, sample, i - 1 AS pos, substr(seq, i, {k}) AS w FROM (SELECT *, unnest(range(1, length(seq) - {k} + 2)) AS i FROM reads))"


def _kmers(k: int) -> str:
    return f"{_windows(k)}, kmers AS (SELECT read_id, grp, sample, pos, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS kmer FROM windows WHERE NOT regexp_matches(w, '[^ACGT]'))"


def _counts(k: int = K, least: int = MIN_COUNT) -> str:
    return f"{_kmers(k)}, counts AS (SELECT sample, grp, kmer, count(*) AS cnt FROM kmers GROUP BY ALL HAVING count(*) >= {least})"


def _presence(cmin1: int = 1, cmin2: int = 0, missing: int = 0) -> str:
    def cell(grp: int, high: bool) -> str:
        test = f"cnt >= {cmin1}" if high else f"cnt < {cmin1} AND cnt <= {cmin2}"
        absent = missing >= cmin1 if high else missing < cmin1 and missing <= cmin2
        return f"count(*) FILTER (grp = {grp} AND {test})" + (f" + (SELECT count(DISTINCT sample) FROM reads WHERE grp = {grp}) - count(*) FILTER (grp = {grp})" if absent else "")

    cells = ", ".join(f"CAST({cell(g, h)} AS BIGINT) AS {n}" for (g, h), n in zip(((1, True), (1, False), (2, True), (2, False)), "abcd", strict=True))
    return f"presence AS (SELECT kmer, {cells} FROM counts GROUP BY kmer)"


def _fisher(alternative: str, source: str = "presence") -> str:
    which = {"two": "lx <= la + 1e-7", "less": "x <= a", "greater": "x >= a", "point": "x = a"}[alternative]
    return f"""terms AS (SELECT a, b, c, d, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS x,
 lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) AS m FROM (SELECT DISTINCT a, b, c, d FROM {source})),
logs AS (SELECT *, m - (lgamma(x + 1) + lgamma(a + b - x + 1) + lgamma(a + c - x + 1) + lgamma(d - a + x + 1)) AS lx,
 m - (lgamma(a + 1) + lgamma(b + 1) + lgamma(c + 1) + lgamma(d + 1)) AS la FROM terms),
tests AS (SELECT a, b, c, d, least(1.0, sum(exp(lx)) FILTER ({which})) AS pval FROM logs GROUP BY a, b, c, d)"""


_LN = "round(ln(pval), 6) + 0.0 AS ln_p"


def _ln_p():
    return (F.round(F.ln("pval"), 6) + F.lit(0.0)).alias("ln_p")


def _sizes(reads: DataFrame) -> tuple[int, int]:
    """Samples in each group: two numbers."""
    found = {r["grp"]: r["n"] for r in reads.groupBy("grp").agg(F.countDistinct("sample").alias("n")).collect()}
    return found.get(1, 0), found.get(2, 0)


def _reads(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    return document_reads(spark, sf_dir, deal=True, joined=k >= LONG_K)


def _sample_counts(spark: SparkSession, sf_dir: str, k: int = K, least: int = MIN_COUNT, packed: bool = True) -> DataFrame:
    """Counts of each sample; k-mers stay packed until a query shows them."""
    return counting.count_kmers(_reads(spark, sf_dir, k), k, least, keys=("sample", "grp"), packed=packed)


def _stored_counts(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """Counts for queries that read them more than once: counted once, and stored by k-mer."""
    return count_store.stored_once(_sample_counts(spark, sf_dir, k), "counts")


def _kmer(k: int = K):
    return counting.kmer_text("kmer", k).alias("kmer")


def _tables(spark: SparkSession, sf_dir: str, k: int = K, sizes: tuple[int, int] | None = None, **thresholds) -> DataFrame:
    n1, n2 = sizes or _sizes(document_reads(spark, sf_dir))
    return presence.presence(_sample_counts(spark, sf_dir, k), n1, n2, **thresholds)


# Samples and reads.


@query(f"WITH {READS} SELECT sample, CAST(grp AS INTEGER) AS grp, count(*) AS n_reads, CAST(sum(length(seq)) AS BIGINT) AS n_bases FROM reads GROUP BY sample, grp")
def manifest_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_reads(spark, sf_dir).groupBy("sample", "grp").agg(F.count("*").alias("n_reads"), F.sum(F.length("seq")).alias("n_bases"))


@query(f"WITH {READS} SELECT CAST(grp AS INTEGER) AS grp, count(DISTINCT sample) AS n_samples FROM reads GROUP BY grp")
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_reads(spark, sf_dir).groupBy("grp").agg(F.countDistinct("sample").alias("n_samples"))


@query(f"WITH {READS} SELECT read_id, sample, seq FROM reads")
def reads_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_reads(spark, sf_dir).select("read_id", "sample", "seq")


@query(f"WITH {READS} SELECT read_id, sample, CAST(length(seq) AS INTEGER) AS n_bases FROM reads WHERE length(seq) < 27")
def reads_too_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_reads(spark, sf_dir).where(F.length("seq") < 27).select("read_id", "sample", F.length("seq").alias("n_bases"))


# k-mers.


@query(f"WITH {_windows(11)} SELECT read_id, count(*) AS n_windows, count(*) FILTER (NOT regexp_matches(w, '[^ACGT]')) AS n_valid, min(w) AS first_kmer, CAST(max(pos) AS INTEGER) AS last_pos FROM windows GROUP BY read_id")
def kmer_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sequences.windows(_reads(spark, sf_dir), 11)
    return cut.groupBy("read_id").agg(F.count("*").alias("n_windows"), F.count_if(sequences.is_valid(F.col("kmer"))).alias("n_valid"), F.min("kmer").alias("first_kmer"), F.max("pos").alias("last_pos"))


@query(f"WITH {_kmers(5)} SELECT kmer, count(*) AS n FROM kmers GROUP BY kmer")
def kmer_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.packed_counts(_reads(spark, sf_dir), 5, ()).select(_kmer(5), F.col("cnt").alias("n"))


@query(f"WITH {_windows(6)} SELECT DISTINCT w AS kmer, reverse(translate(w, 'ACGT', 'TGCA')) AS rc, w = reverse(translate(w, 'ACGT', 'TGCA')) AS palindrome FROM windows WHERE NOT regexp_matches(w, '[^ACGT]')")
def kmer_reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = counting.packed_counts(_reads(spark, sf_dir), 6, (), both_strands=False).select(_kmer(6))
    rc = sequences.reverse_complement(F.col("kmer"))
    return own.select("kmer", rc.alias("rc"), (F.col("kmer") == rc).alias("palindrome"))


@query(f"WITH {_counts(least=1)} SELECT sample, kmer, cnt FROM counts")
def kmer_count_per_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_counts(spark, sf_dir, least=1).select("sample", _kmer(), "cnt")


@query(f"WITH {_counts()} SELECT sample, kmer, cnt FROM counts")
def kmer_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_counts(spark, sf_dir).select("sample", _kmer(), "cnt")


@query(f"WITH {_counts(27)} SELECT sample, kmer, cnt FROM counts")
def kmer_count_k27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual length, at which tables grow with the reads."""
    return _sample_counts(spark, sf_dir, 27).select("sample", _kmer(27), "cnt")


@query(f"WITH {_counts(27)} SELECT sample, kmer, cnt FROM counts")
def kmer_count_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts by packed stretches of reads, shuffled by signature and counted inside their bins."""
    return superkmers.superkmer_counts(_reads(spark, sf_dir, 27), 27, MIN_COUNT).select("sample", _kmer(27), "cnt")


@query(f"WITH {_counts(33)} SELECT sample, kmer, cnt FROM counts")
def kmer_count_k33(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-mers that no longer fit a number."""
    return counting.count_kmers(_reads(spark, sf_dir, 33), 33, MIN_COUNT, keys=("sample", "grp")).select("sample", "kmer", "cnt")


@query(f"WITH {_counts()}, twice AS (SELECT sample, kmer FROM counts UNION ALL SELECT sample, kmer FROM counts WHERE cnt >= 100) SELECT sample, kmer, count(*) AS n FROM twice GROUP BY ALL HAVING count(*) > 1")
def kmer_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check for repeated k-mers, on a table to which frequent ones were added once more."""
    counts = _sample_counts(spark, sf_dir)
    return counting.repeated_rows(counts.unionByName(counts.where("cnt >= 100"))).select("sample", _kmer(), "n")


@query(f"WITH {_counts(4)} SELECT sample, kmer, least(cnt, 255) AS cnt FROM counts")
def kmer_count_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_kmers(_reads(spark, sf_dir), 4, MIN_COUNT, count_cap=255)


@query(f"WITH {_counts(9, 1)} SELECT sample, kmer, 2 * cnt AS cnt FROM counts")
def kmer_low_coverage_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_kmers(_reads(spark, sf_dir), 9, MIN_COUNT, times=2)


@query(f"WITH {_counts()} SELECT DISTINCT kmer FROM counts")
def kmer_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.universe(_sample_counts(spark, sf_dir)).select(_kmer())


@query(f"WITH {_counts()} SELECT kmer, CAST(least(sum(cnt), 1000000) AS BIGINT) AS cnt FROM counts GROUP BY kmer")
def kmer_union_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.union_sum(_sample_counts(spark, sf_dir)).select(_kmer(), "cnt")


@query(f"WITH {_counts()} SELECT u.kmer, coalesce(s.cnt, 1) AS cnt FROM (SELECT DISTINCT kmer FROM counts) u LEFT JOIN (SELECT kmer, CAST(sum(cnt) AS BIGINT) AS cnt FROM counts WHERE grp = 1 GROUP BY kmer) s ON u.kmer = s.kmer")
def kmer_right_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All k-mers with their counts in group 1 as one table; ``kmer_right_count_all`` has every sample."""
    counts = _stored_counts(spark, sf_dir)
    return counting.right_counts(counting.universe(counts), counting.union_sum(counts.where("grp = 1"), 1 << 62)).select(_kmer(), "cnt")


@query(f"WITH {_counts()} SELECT u.kmer, s.sample, coalesce(c.cnt, 1) AS cnt FROM (SELECT DISTINCT kmer FROM counts) u CROSS JOIN (SELECT DISTINCT sample FROM reads) s LEFT JOIN counts c ON c.kmer = u.kmer AND c.sample = s.sample")
def kmer_right_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample as ``kmer_right_count`` has one."""
    return matrix.right_counts(_sample_counts(spark, sf_dir), manifest.sample_order(document_reads(spark, sf_dir))).select(_kmer(), "sample", "cnt")


@query(f"WITH {_counts()} SELECT DISTINCT kmer, CAST(1 AS BIGINT) AS cnt FROM counts")
def kmer_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.compact(_sample_counts(spark, sf_dir)).select(_kmer(), "cnt")


@query(f"WITH {_counts()}, u AS (SELECT kmer, max(CASE WHEN grp = 1 THEN 1 ELSE 0 END) g1, max(CASE WHEN grp = 2 THEN 1 ELSE 0 END) g2 FROM counts GROUP BY kmer) SELECT CASE WHEN g1 = 1 AND g2 = 1 THEN 'both' WHEN g1 = 1 THEN 'group 1' ELSE 'group 2' END AS side, count(*) AS n_kmers FROM u GROUP BY ALL")
def kmer_set_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = _sample_counts(spark, sf_dir).groupBy("kmer").agg(F.max((F.col("grp") == 1).cast("int")).alias("g1"), F.max((F.col("grp") == 2).cast("int")).alias("g2"))
    side = F.when((F.col("g1") == 1) & (F.col("g2") == 1), "both").when(F.col("g1") == 1, "group 1").otherwise("group 2")
    return sides.groupBy(side.alias("side")).agg(F.count("*").alias("n_kmers"))


# Matrices.

# The samples of the test tables: fixed values of the SQL only, since a query there must name its columns.
_LANGUAGES = ("de", "en", "es", "fr")
_SAMPLES = [f"{lang}-src{i}" for lang in _LANGUAGES for i in range(20)]


@query("WITH " + _counts(5) + " SELECT kmer, " + ", ".join(f"""coalesce(max(cnt) FILTER (sample = '{s}'), 0) AS "{s}\"""" for s in _SAMPLES) + " FROM counts GROUP BY kmer")
def count_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column for every sample of both groups."""
    samples = manifest.sample_order(document_reads(spark, sf_dir))
    wide = matrix.count_matrix(_sample_counts(spark, sf_dir, 5), samples)
    return wide.select(_kmer(5), *[F.col(f"`{s}`") for s in samples])


@query(
    f"WITH {_counts(5)}, samples AS (SELECT DISTINCT grp, sample, [CASE WHEN regexp_matches(p, '[0-9]') THEN {{'kind': 1, 'n': CAST(p AS BIGINT), 's': ''}} ELSE {{'kind': 0, 'n': CAST(0 AS BIGINT), 's': p}} END"
    " FOR p IN regexp_extract_all(sample, '[0-9]+|[^0-9]+')] AS natural_key FROM reads),"
    " cells AS (SELECT u.kmer, s.grp, s.natural_key, coalesce(c.cnt, 0) AS cnt FROM (SELECT DISTINCT kmer FROM counts) u CROSS JOIN samples s LEFT JOIN counts c ON c.kmer = u.kmer AND c.sample = s.sample)"
    " SELECT kmer, string_agg(CAST(cnt AS VARCHAR), chr(9) ORDER BY grp, natural_key) AS cells FROM cells GROUP BY kmer"
)
def count_matrix_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All samples, as lines of a matrix file: group 1 first, each group in natural order."""
    samples = manifest.sample_order(document_reads(spark, sf_dir))
    return matrix.count_arrays(_sample_counts(spark, sf_dir, 5), samples).select(_kmer(5), F.array_join(F.col("counts").cast("array<string>"), "\t").alias("cells"))


@query(
    "WITH n AS (SELECT n_nationkey FROM nation), t AS (SELECT l_partkey, c_nationkey, count(*) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
    " SELECT l_partkey, " + ", ".join(f"coalesce(max(cnt) FILTER (c_nationkey = {i}), 0) AS n{i}" for i in range(25)) + " FROM t GROUP BY l_partkey"
)
def count_matrix_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = _bought(spark, sf_dir).groupBy("l_partkey", "c_nationkey").agg(F.count("*").alias("cnt"))
    nations = [f"n{i}" for i in range(25)]
    wide = matrix.count_matrix(bought.select(F.col("l_partkey").alias("kmer"), F.concat(F.lit("n"), "c_nationkey").alias("sample"), "cnt"), nations)
    return wide.withColumnRenamed("kmer", "l_partkey")


# Presence and tests.


@query(f"WITH {_counts()}, {_presence()} SELECT * FROM presence")
def presence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).select(_kmer(), "a", "b", "c", "d")


@query(f"WITH {_counts()}, {_presence(3, 1)} SELECT * FROM presence")
def presence_grey_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir, cmin1=3, cmin2=1).select(_kmer(), "a", "b", "c", "d")


@query(f"WITH {_counts()}, {_presence(2, 1, 1)} SELECT * FROM presence")
def presence_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir, cmin1=2, cmin2=1, missing=1).select(_kmer(), "a", "b", "c", "d")


def _fisher_query(alternative: str):
    sql = f"WITH {_counts()}, {_presence()}, {_fisher(alternative)} SELECT kmer, a, b, c, d, {_LN} FROM presence JOIN tests USING (a, b, c, d)"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return statistics.with_fisher(_tables(spark, sf_dir), alternative).select(_kmer(), "a", "b", "c", "d", _ln_p())

    run.__name__ = f"fisher_{ {'two': 'two_sided'}.get(alternative, alternative) }"
    return query(sql)(run)


for _alternative in statistics.ALTERNATIVES:
    _fisher_query(_alternative)

@query(f"WITH {_counts()}, {_presence()}, {_fisher('two')} SELECT kmer, a, b, c, d, {_LN} FROM presence JOIN tests USING (a, b, c, d)")
def fisher_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fisher_two_sided``, in one SQL statement with the library's functions."""
    sql.register_fisher(spark)
    sql.register_kmers(spark)
    n1, n2 = _sizes(document_reads(spark, sf_dir))
    return spark.sql(
        f"""WITH counts AS (SELECT sample, grp, kmer, sum(cnt) AS cnt FROM kmers(TABLE(SELECT sample, grp, seq FROM {{reads}}), {K}) GROUP BY sample, grp, kmer HAVING sum(cnt) >= {MIN_COUNT}),
        presence AS (SELECT kmer, count_if(grp = 1) AS a, {n1} - count_if(grp = 1) AS b, count_if(grp = 2) AS c, {n2} - count_if(grp = 2) AS d FROM counts GROUP BY kmer)
        SELECT kmer, a, b, c, d, round(ln(fisher_exact(a, b, c, d)), 6) + 0.0D AS ln_p FROM presence""",
        reads=_reads(spark, sf_dir),
    )


_SIGNIFICANT = f"{_counts()}, {_presence()}, {_fisher('two')}, significant AS (SELECT kmer, a, b, c, d, pval FROM presence JOIN tests USING (a, b, c, d) WHERE pval < {P_CUT})"


def _significant(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    return presence.significant(_tables(spark, sf_dir, k), P_CUT)


@query(f"WITH {_SIGNIFICANT} SELECT kmer, a, b, c, d, {_LN} FROM significant")
def significant_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _significant(spark, sf_dir).select(_kmer(), "a", "b", "c", "d", _ln_p())


@query(f"WITH {_counts(27)}, {_presence()}, {_fisher('two')} SELECT kmer, a, b, c, d, {_LN} FROM presence JOIN tests USING (a, b, c, d) WHERE pval < {P_CUT}")
def significant_k27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``significant_kmers``, at the usual length."""
    return _significant(spark, sf_dir, 27).select(_kmer(27), "a", "b", "c", "d", _ln_p())


@query(f"WITH {_counts()}, {_presence(2, 1, 1)}, {_fisher('point')} SELECT kmer, a, b, c, d, {_LN} FROM presence JOIN tests USING (a, b, c, d) WHERE CAST(format('{{:.6g}}', pval) AS DOUBLE) <= {P_CUT}")
def significant_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir, cmin1=2, cmin2=1, missing=1)
    return presence.significant(tables, P_CUT, "point", printed=True).select(_kmer(), "a", "b", "c", "d", _ln_p())


@query(f"WITH {_SIGNIFICANT} SELECT a, b, c, d, {_LN}, count(*) AS n_kmers FROM significant GROUP BY pval, a, b, c, d ORDER BY ln_p, a, b, c, d LIMIT 9")
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = _significant(spark, sf_dir).select("a", "b", "c", "d", _ln_p().alias("pval"))
    return report.top_groups(tested).select("a", "b", "c", "d", F.col("pval").alias("ln_p"), "n_kmers")


@query(f"WITH {_SIGNIFICANT}, p6 AS (SELECT kmer, format('{{:.6g}}', pval) AS p6 FROM significant), r AS (SELECT *, row_number() OVER (ORDER BY CAST(p6 AS DOUBLE), kmer) AS rank FROM p6) SELECT rank, 'kmer' || rank || '_pval_' || p6 AS name, kmer AS seq FROM r")
def ranked_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.fasta_records(report.ranked(_significant(spark, sf_dir)).withColumn("kmer", _kmer()))


@query(f"WITH {_counts()} SELECT sample, round(avg(cnt), 9) AS mean_depth FROM counts WHERE cnt > 1 GROUP BY sample")
def sample_mean_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.mean_depth(_sample_counts(spark, sf_dir)).select("sample", F.round("mean_depth", 9).alias("mean_depth"))


@query(f"WITH {_SIGNIFICANT} SELECT sample, round(avg(cnt), 9) AS mean_depth FROM counts SEMI JOIN significant USING (kmer) WHERE cnt > 1 GROUP BY sample")
def significant_mean_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _stored_counts(spark, sf_dir)
    counts = lookup.contained(counts, presence.significant(presence.presence(counts, *_sizes(document_reads(spark, sf_dir))), P_CUT))
    return report.mean_depth(counts).select("sample", F.round("mean_depth", 9).alias("mean_depth"))


def _specific(group: int, share: float):
    own, other = ("a", "c") if group == 1 else ("c", "a")
    sql = f"WITH {_counts()}, {_presence()} SELECT kmer, a, b, c, d FROM presence WHERE {own} >= {share} * (SELECT count(DISTINCT sample) FROM reads WHERE grp = {group}) AND {other} = 0"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sizes = _sizes(document_reads(spark, sf_dir))
        return presence.group_specific(_tables(spark, sf_dir, sizes=sizes), *sizes, group, share).select(_kmer(), "a", "b", "c", "d")

    run.__name__ = f"specific_group{group}"
    return query(sql)(run)


# No k-mer is in all 60 samples of three languages and in none of the fourth: a quarter of them is asked of group 2.
_specific(1, 1.0)
_specific(2, 0.25)


# Annotated tables and stored counts.


@query(f"WITH {_counts(11)}, {_presence()} SELECT kmer, a, b, c, d FROM presence")
def stored_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence over a store of counts by k-mer to which one group's samples come after the other's."""
    counts = _sample_counts(spark, sf_dir, 11)
    path, name = scratch(spark, "store"), f"kmerloom_store_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count_store.store_counts(counts.where("grp = 1"), path, name, buckets)
    stored = count_store.store_counts(counts.where("grp = 2"), path, name, buckets)
    return presence.presence(stored, *_sizes(document_reads(spark, sf_dir))).select(_kmer(11), "a", "b", "c", "d")

_ORDER = (
    "samples AS (SELECT DISTINCT grp, sample, [CASE WHEN regexp_matches(p, '[0-9]') THEN {'kind': 1, 'n': CAST(p AS BIGINT), 's': ''} ELSE {'kind': 0, 'n': CAST(0 AS BIGINT), 's': p} END"
    " FOR p IN regexp_extract_all(sample, '[0-9]+|[^0-9]+')] AS natural_key FROM reads)"
)
_ANNOTATED = (
    f"{_SIGNIFICANT}, {_ORDER}, cells AS (SELECT u.*, s.grp, s.natural_key, coalesce(c.cnt, 0) AS cnt FROM significant u CROSS JOIN samples s LEFT JOIN counts c ON c.kmer = u.kmer AND c.sample = s.sample)"
)


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = document_reads(spark, sf_dir)
    counts = _stored_counts(spark, sf_dir)
    tested = presence.significant(presence.presence(counts, *_sizes(reads)), P_CUT)
    return report.annotated(tested, counts, manifest.sample_order(reads))


@query(f"WITH {_ANNOTATED} SELECT kmer, a, b, c, d, {_LN}, string_agg(CAST(cnt AS VARCHAR), chr(9) ORDER BY grp, natural_key) AS cells FROM cells GROUP BY kmer, a, b, c, d, pval")
def annotated_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Significant k-mers with the counts of every sample, group 1 first, each group in natural order."""
    return _annotated(spark, sf_dir).select(_kmer(), "a", "b", "c", "d", _ln_p(), F.array_join(F.col("counts").cast("array<string>"), "\t").alias("cells"))


@query(
    f"WITH {_ANNOTATED}, places AS (SELECT grp, natural_key, CAST(6 + row_number() OVER (ORDER BY grp, natural_key) AS INTEGER) AS field FROM samples)"
    " SELECT field, round(avg(cnt), 9) AS avg FROM cells JOIN places USING (grp, natural_key) WHERE cnt > 1 GROUP BY field"
)
def field_means_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The means of the annotated table's fields, read back from its lines."""
    rows = _annotated(spark, sf_dir)
    value = F.concat_ws("\t", F.col("pval").cast("string"), "a", "b", "c", "d", _kmer(), F.col("counts").cast("array<string>"))
    return matrix.field_means(rows.select(value.alias("value"))).select("field", F.round("avg", 9).alias("avg"))


@query(f"WITH {_SIGNIFICANT} SELECT kmer, a, b, c, d, {_LN} FROM significant")
def matrix_lines_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same k-mers from the lines of a matrix, as a table that came with its counts ready is tested."""
    reads = document_reads(spark, sf_dir)
    samples = manifest.sample_order(reads)
    rows = matrix.count_arrays(_sample_counts(spark, sf_dir), samples)
    lines = rows.select(F.concat_ws("\t", _kmer(), F.col("counts").cast("array<string>")).alias("value"))
    return presence.significant(matrix.line_tables(lines, _sizes(reads)[0]), P_CUT).select("kmer", "a", "b", "c", "d", _ln_p())


# Lookups.


@query(f"WITH {_counts()}, db AS (SELECT kmer, CAST(sum(cnt) AS BIGINT) AS cnt FROM counts WHERE grp = 1 GROUP BY kmer), probe AS (SELECT DISTINCT kmer FROM counts WHERE grp = 2) SELECT probe.kmer, db.cnt IS NOT NULL AS found, coalesce(db.cnt, 0) AS cnt FROM probe LEFT JOIN db ON probe.kmer = db.kmer AND db.cnt BETWEEN 3 AND 10000")
def kmer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _stored_counts(spark, sf_dir)
    found = lookup.lookup(counting.universe(counts.where("grp = 2")), counting.union_sum(counts.where("grp = 1")), 3, 10_000)
    return found.select(_kmer(), F.col("cnt").isNotNull().alias("found"), F.coalesce("cnt", F.lit(0).cast("long")).alias("cnt"))


@query(f"WITH {_counts()} SELECT DISTINCT kmer FROM counts WHERE grp = 2 AND kmer IN (SELECT kmer FROM counts WHERE grp = 1)")
def kmer_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _stored_counts(spark, sf_dir)
    return lookup.contained(counting.universe(counts.where("grp = 2")), counting.universe(counts.where("grp = 1"))).select(_kmer())


@query(
    f"WITH {_counts(11)}, db AS (SELECT kmer, CAST(sum(cnt) AS BIGINT) AS cnt FROM counts WHERE grp = 1 GROUP BY kmer),"
    " found AS (SELECT windows.read_id, coalesce(db.cnt, 0) AS cnt, pos FROM windows LEFT JOIN db ON NOT regexp_matches(w, '[^ACGT]') AND db.kmer = least(w, reverse(translate(w, 'ACGT', 'TGCA'))))"
    " SELECT read_id, count(*) AS n_pos, CAST(sum(cnt) AS BIGINT) AS total, max(cnt) AS highest, count(*) FILTER (cnt = 0) AS n_absent, CAST(sum(cnt * (pos % 1000)) AS BIGINT) AS by_place FROM found GROUP BY read_id"
)
def read_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _reads(spark, sf_dir)
    db = counting.union_sum(counting.count_kmers(reads.where("grp = 1"), 11, MIN_COUNT, keys=("sample", "grp"), packed=True), 1 << 62)
    return lookup.counters(reads, db, 11).groupBy("read_id").agg(F.count("*").alias("n_pos"), F.sum("cnt").alias("total"), F.max("cnt").alias("highest"), F.count_if(F.col("cnt") == 0).alias("n_absent"), F.sum(F.col("cnt") * (F.col("pos") % 1000)).alias("by_place"))


@query(f"WITH {_counts()} SELECT sample, min(cnt) AS min_count, max(cnt) AS max_count, count(*) AS total_kmers, CAST({K} AS INTEGER) AS kmer_length, true AS both_strands FROM counts GROUP BY sample")
def db_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.database_info(_sample_counts(spark, sf_dir), K)


@query(f"WITH {_counts()} SELECT sample, count(*) AS n_kmers FROM counts WHERE cnt BETWEEN 3 AND 10 GROUP BY sample")
def db_count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_range(_sample_counts(spark, sf_dir), 3, 10).groupBy("sample").agg(F.count("*").alias("n_kmers"))


# Scalar functions.

_PACK = " + ".join(f"(instr('ACGT', substr(kmer, {i + 1}, 1)) - 1) * {4 ** (8 - i)}" for i in range(9))


@query(f"WITH {_kmers(9)} SELECT DISTINCT kmer, CAST({_PACK} AS BIGINT) AS packed, kmer AS unpacked, CAST(instr('ACGT', substr(kmer, 3, 1)) - 1 AS INTEGER) AS third FROM kmers")
def kmer_pack_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = counting.packed_counts(_reads(spark, sf_dir), 9, ()).select(_kmer(9))
    number = sequences.packed(F.col("kmer"), 9)
    return own.select("kmer", number.alias("packed"), sequences.unpacked(number, 9).alias("unpacked"), sequences.code_at(F.col("kmer"), 2).alias("third"))


def _mmer_value(w: str) -> str:
    return " + ".join(f"(instr('ACGT', substr({w}, {i + 1}, 1)) - 1) * {4 ** (4 - i)}" for i in range(5))


def _mmer_allowed(w: str) -> str:
    return f"NOT (regexp_matches({w}, '(TTT|TGT|TT.)$') OR regexp_matches({w}, '^.+AA') OR regexp_matches({w}, '^(AAA|ACA)'))"


@query(
    f"WITH {_kmers(9)}, own AS (SELECT DISTINCT kmer FROM kmers), cut AS (SELECT kmer, substr(kmer, i, 5) AS m, reverse(translate(substr(kmer, i, 5), 'ACGT', 'TGCA')) AS rc FROM own, range(1, 6) AS t(i)),"
    f" n AS (SELECT kmer, CASE WHEN {_mmer_allowed('m')} THEN {_mmer_value('m')} END AS f, CASE WHEN {_mmer_allowed('rc')} THEN {_mmer_value('rc')} END AS b FROM cut)"
    " SELECT kmer, CAST(min(coalesce(least(f, b), 1024)) AS BIGINT) AS signature FROM n GROUP BY kmer"
)
def kmer_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = counting.packed_counts(_reads(spark, sf_dir), 9, ()).select(_kmer(9))
    return signatures.signatures(own, 5).select("kmer", F.col("signature").cast("long").alias("signature"))


_RAW = "CASE CAST(event_id % 7 AS INTEGER) WHEN 0 THEN CAST(event_id AS VARCHAR) || 'abc' WHEN 1 THEN '' WHEN 2 THEN event_type WHEN 3 THEN ' ' || CAST(user_id AS VARCHAR) WHEN 4 THEN '-' || CAST(user_id AS VARCHAR) || '.5e1z' WHEN 5 THEN '0x' || CAST(user_id AS VARCHAR) ELSE '.' || CAST(user_id AS VARCHAR) END"


@query(f"SELECT event_id, {_RAW} AS raw, coalesce(TRY_CAST(regexp_extract({_RAW}, '^[ \\t]*([+-]?(?:[0-9]+(?:\\.[0-9]*)?|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?)', 1) AS DOUBLE), 0.0) AS number FROM events")
def lenient_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    raw = events.select("event_id", F.expr(_RAW.replace("VARCHAR", "STRING").replace("INTEGER", "INT")).alias("raw"))
    return raw.withColumn("number", parsing.lenient_number(F.col("raw")))


# Other features by samples.


def _bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders, customer = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "customer"))
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))


def _enrichment(members: str, uses: str, p_cut: float) -> str:
    return f"""WITH members AS ({members}), uses AS ({uses}), n AS (SELECT count(*) FILTER (grp = 1) AS n1, count(*) FILTER (grp = 2) AS n2 FROM members),
 hits AS (SELECT feature, count(*) FILTER (grp = 1) AS a, count(*) FILTER (grp = 2) AS c FROM uses GROUP BY feature),
 presence AS (SELECT feature, a, n1 - a AS b, c, n2 - c AS d FROM hits, n), {_fisher('two')}
 SELECT feature, a, b, c, d, {_LN} FROM presence JOIN tests USING (a, b, c, d) WHERE pval < {p_cut}"""


@query(
    _enrichment(
        "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 ELSE 2 END AS grp FROM customer",
        "SELECT DISTINCT l_partkey AS feature, o_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 ELSE 2 END AS grp FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
        0.05,
    )
)
def part_segment_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    grp = F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(2).alias("grp")
    sizes = {r["grp"]: r["n"] for r in spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(grp).agg(F.count("*").alias("n")).collect()}
    uses = _bought(spark, sf_dir).groupBy(F.col("l_partkey").alias("feature"), "o_custkey", grp).agg(F.count("*").alias("cnt"))
    tables = presence.presence(uses, sizes.get(1, 0), sizes.get(2, 0), feature="feature")
    return presence.significant(tables, 0.05).select("feature", "a", "b", "c", "d", _ln_p())


@query(
    _enrichment(
        "SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 2 END AS grp FROM events GROUP BY user_id",
        "SELECT DISTINCT event_type || '-' || hour(ts) AS feature, user_id, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 2 END AS grp FROM events",
        2,
    )
)
def event_user_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    grp = F.when(F.col("user_id") % 2 == 0, 1).otherwise(2).alias("grp")
    sizes = {r["grp"]: r["n"] for r in events.groupBy(grp).agg(F.countDistinct("user_id").alias("n")).collect()}
    uses = events.groupBy(F.concat_ws("-", "event_type", F.hour("ts")).alias("feature"), "user_id", grp).agg(F.count("*").alias("cnt"))
    tables = presence.presence(uses, sizes.get(1, 0), sizes.get(2, 0), feature="feature")
    return presence.significant(tables, 2).select("feature", "a", "b", "c", "d", _ln_p())


# Assembly and streaming.


def _rc(w: str) -> str:
    return f"reverse(translate({w}, 'ACGT', 'TGCA'))"


# Walks over kept links, from first nodes on; what no walk meets lies on rings, which are cut at their smallest k-mer.
_UNITIGS = f"""WITH RECURSIVE {_SIGNIFICANT}, nodes AS (SELECT kmer AS u FROM significant UNION SELECT {_rc('kmer')} FROM significant),
 links AS (SELECT a.u, b.u AS v FROM nodes a JOIN nodes b ON substr(a.u, 2) = substr(b.u, 1, {K - 1})),
 only_out AS (SELECT u, min(v) AS v FROM links GROUP BY u HAVING count(*) = 1), only_in AS (SELECT v FROM links GROUP BY v HAVING count(*) = 1),
 chain AS MATERIALIZED (SELECT u, v FROM only_out SEMI JOIN only_in USING (v) WHERE u <> v AND v <> {_rc('u')}),
 open AS (SELECT u AS node FROM nodes WHERE u NOT IN (SELECT v FROM chain) UNION ALL SELECT v FROM open JOIN chain ON node = u),
 rings AS MATERIALIZED (SELECT u AS v FROM nodes WHERE u NOT IN (SELECT node FROM open)),
 turns AS (SELECT v AS start, v AS node, false AS done FROM rings UNION ALL SELECT start, chain.v, chain.v = start FROM turns JOIN chain ON node = u WHERE NOT done),
 smallest AS (SELECT start AS node, min(least(node, {_rc('node')})) AS least FROM turns GROUP BY start),
 cut AS MATERIALIZED (SELECT u, v FROM chain LEFT JOIN smallest ON smallest.node = v LEFT JOIN smallest own ON own.node = u WHERE (smallest.least IS NULL OR smallest.least <> v) AND (own.least IS NULL OR own.least = u OR own.least <> {_rc('u')})),
 walks AS (SELECT u AS node, u AS seq, CAST(1 AS BIGINT) AS n FROM nodes WHERE u NOT IN (SELECT v FROM cut) UNION ALL SELECT v, seq || right(v, 1), n + 1 FROM walks JOIN cut ON node = u),
 ends AS (SELECT seq, n FROM walks WHERE node NOT IN (SELECT u FROM cut))
 SELECT DISTINCT least(seq, {_rc('seq')}) AS seq, n AS n_kmers FROM ends"""


@query(_UNITIGS)
def unitigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs of the significant k-mers."""
    return assembly.unitigs(_significant(spark, sf_dir).select(_kmer()), K)


@query(f"WITH {_counts()} SELECT sample, kmer, cnt FROM counts")
def streamed_cohort_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from a stream of read files."""
    path = scratch(spark, "cohort")
    documents = f"{sf_dir}/documents.parquet"
    schema = spark.read.parquet(documents).schema
    # A stream reads folders; a table of one file is given by name.
    folder, name = (documents, "*") if _is_folder(spark, documents) else (sf_dir, "documents.parquet")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    grp = F.when(F.col("lang") == "en", 1).otherwise(2)
    known = stream.where("text is not null and lang is not null and source is not null")
    reads = known.select(F.col("doc_id").alias("read_id"), grp.alias("grp"), F.concat_ws("-", "lang", "source").alias("sample"), sequences.text_to_bases(F.col("text")).alias("seq"))
    cohort.append_counts(reads, K, f"{path}/counts", f"{path}/state")
    table = spark.read.schema(cohort.SCHEMA).parquet(f"{path}/counts")
    return cohort.cohort_counts(table).select("sample", _kmer(), "cnt")


def _is_folder(spark: SparkSession, path: str) -> bool:
    files = spark.read.format("parquet").load(path).inputFiles()
    return not any(f.endswith("/documents.parquet") for f in files)
