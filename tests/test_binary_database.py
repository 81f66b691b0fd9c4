import random
import struct

import pytest

from kmerloom.jobs.association import Settings, run_association, run_databases
from kmerloom.operators import counting
from kmerloom.sources import binary_database as db
from kmerloom.sources.reads import table_header


def number(text):
    return sum("ACGT".index(c) * 4 ** (len(text) - 1 - i) for i, c in enumerate(text))


def signature_of(kmer, m):
    """The smallest m-mer of a k-mer, by the rule of the format."""

    def value(w):
        refused = w.endswith(("TTT", "TGT")) or w[-3:-1] == "TT" or "AA" in w[1:] or w.startswith(("AAA", "ACA"))
        return 4**m if refused else number(w)

    other = kmer[::-1].translate(str.maketrans("ACGT", "TGCA"))
    return min(value(w[i : i + m]) for w in (kmer, other) for i in range(len(kmer) - m + 1))


def save(path, counts, k, prefix, version=db.BINNED, bins=3, counter=2, signature=5, single_strand=0, mode=0, limits=None):
    """A database as the format asks: k-mers dealt to bins by their signatures, each bin sorted."""
    rng = random.Random(1)
    parts = [[] for _ in range(bins if version == db.BINNED else 1)]
    places = [rng.randrange(len(parts)) for _ in range(4**signature + 1)]
    for kmer in counts:
        parts[places[signature_of(kmer, signature)] if version == db.BINNED else 0].append(kmer)
    table, records, total = [], [], 0
    for part in parts:
        by = {}
        for kmer in sorted(part):
            by.setdefault(number(kmer[:prefix]), []).append(kmer)
        for p in range(4**prefix):
            table.append(total)
            own = by.get(p, [])
            records += [number(kmer[prefix:]).to_bytes((k - prefix) // 4, "big") + counts[kmer].to_bytes(counter, "little") for kmer in own]
            total += len(own)
    records = b"".join(records)
    low, high = limits or (min(counts.values(), default=1), max(counts.values(), default=1))
    if version == db.BINNED:
        head = struct.pack("<7IQB", k, mode, counter, prefix, signature, low, high, total, single_strand) + bytes(19)
        middle = struct.pack(f"<{len(table) + 1}Q", *table, total) + struct.pack(f"<{len(places)}I", *places)
    else:
        head = struct.pack("<6IQBI", k, mode, counter, prefix, low, high & 0xFFFFFFFF, total, single_strand, high >> 32) + bytes(15)
        middle = struct.pack(f"<{len(table) + 1}Q", *table, total)
    head += struct.pack("<I", version)
    with open(f"{path}.kmc_pre", "wb") as f:
        f.write(db.PREFIX_MARK + middle + head + struct.pack("<I", len(head)) + db.PREFIX_MARK)
    with open(f"{path}.kmc_suf", "wb") as f:
        f.write(db.SUFFIX_MARK + records + db.SUFFIX_MARK)


def table(k, n, seed=3, most=60_000):
    rng = random.Random(seed)
    return {"".join(rng.choices("ACGT", k=k)): rng.randint(1, most) for _ in range(n)}


@pytest.mark.parametrize(("k", "prefix", "version", "counter"), [(9, 1, db.BINNED, 2), (27, 3, db.BINNED, 4), (35, 3, db.BINNED, 3), (12, 4, db.SINGLE, 2), (9, 5, db.SINGLE, 2)])
def test_reading(spark, tmp_path, monkeypatch, k, prefix, version, counter):
    monkeypatch.setattr(db, "ENTRIES", 50)
    monkeypatch.setattr(db, "RECORDS", 17)
    counts, path = table(k, 300), str(tmp_path / "s")
    save(path, counts, k, prefix, version, counter=counter)
    df = db.read_database(spark, path)
    assert {r["kmer"]: r["cnt"] for r in df.collect()} == counts and df.count() == len(counts)
    info = db.read_info(path)
    assert (info.kmer_length, info.counter_size, info.total_kmers, info.both_strands, info.binned) == (k, counter, len(counts), True, version == db.BINNED)
    assert (info.min_count, info.max_count) == (min(counts.values()), max(counts.values()))


def test_sets_without_counts_and_empty_databases(spark, tmp_path):
    save(str(tmp_path / "set"), dict.fromkeys(table(9, 20), 0), 9, 1, counter=0)
    assert {r["cnt"] for r in db.read_database(spark, str(tmp_path / "set")).collect()} == {1}
    save(str(tmp_path / "none"), {}, 9, 1)
    assert db.read_database(spark, str(tmp_path / "none")).count() == 0


def test_cohort_of_databases(spark, tmp_path):
    one, two = table(9, 50, 1), table(9, 50, 1) | table(9, 20, 2)
    for name, counts in (("f", one), ("m", two)):
        save(str(tmp_path / name), counts, 9, 1, single_strand=name == "m")
    paths = {name: str(tmp_path / name) for name in "fm"}
    found = db.read_databases(spark, paths)
    assert counting.universe(found).count() == len(set(one) | set(two))
    assert counting.repeated_rows(found).count() == 0
    facts = {r["path"]: r for r in db.database_facts(spark, list(paths.values())).collect()}
    assert facts[paths["f"]]["both_strands"] and not facts[paths["m"]]["both_strands"]
    save(str(tmp_path / "x"), table(13, 5), 13, 1)
    with pytest.raises(ValueError, match="different lengths"):
        db.read_databases(spark, paths | {"x": str(tmp_path / "x")})


def test_damaged_files_are_refused(tmp_path):
    path = str(tmp_path / "s")

    def change(ending, edit):
        save(path, table(9, 30), 9, 1)
        data = bytearray(open(f"{path}.{ending}", "rb").read())
        edit(data)
        open(f"{path}.{ending}", "wb").write(data)

    def mark(data):
        data[-1] = 0

    def version(data):
        data[-12:-8] = b"\x09\0\0\0"

    def shorter(data):
        del data[4:12]

    for ending, edit in (("kmc_pre", mark), ("kmc_suf", mark), ("kmc_pre", version), ("kmc_suf", shorter), ("kmc_pre", shorter)):
        change(ending, edit)
        with pytest.raises(ValueError):
            db.read_info(path)
    save(path, table(9, 30), 9, 1, mode=1)
    with pytest.raises(ValueError, match="mode"):
        db.read_info(path)
    save(path, table(9, 30), 9, 1)
    data = bytearray(open(f"{path}.kmc_pre", "rb").read())
    data[4 + 16 : 4 + 24] = struct.pack("<Q", 10**6)
    open(f"{path}.kmc_pre", "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        list(db._Reader([(None, path)]).read(db._Ranges([(0, 0, 12)])))


FORMATS = [(9, 1, db.BINNED, 2), (27, 3, db.BINNED, 4), (35, 3, db.BINNED, 3), (12, 4, db.SINGLE, 2), (8, 0, db.BINNED, 1)]


@pytest.mark.parametrize(("k", "prefix", "version", "counter"), FORMATS)
def test_lookups_by_index(spark, tmp_path, monkeypatch, k, prefix, version, counter):
    monkeypatch.setattr(db, "PAGE", 7)
    counts, path = table(k, 400, most=200), str(tmp_path / "s")
    save(path, counts, k, prefix, version, counter=counter)
    asked = [*list(counts)[:150], *table(k, 100, seed=9), "A" * k, None, "", "N" * k, "A" * (k + 1), list(counts)[0], list(counts)[0].lower()]
    probe = spark.createDataFrame(list(enumerate(asked)), "n int, kmer string").repartition(3)
    got = {r["n"]: r["cnt"] for r in db.find_kmers(probe, path).collect()}
    assert got == {n: counts.get(w) for n, w in enumerate(asked)}
    narrow = {r["n"]: r["cnt"] for r in db.find_kmers(probe, path, 50, 120).collect()}
    assert narrow == {n: c if c is not None and 50 <= c <= 120 else None for n, c in got.items()}


def test_lookups_read_little(tmp_path, monkeypatch):
    """A thousand k-mers of 200,000 read less than a twentieth of the records."""
    k, path = 20, str(tmp_path / "s")
    rng = random.Random(5)
    counts = {"".join(rng.choices("ACGT", k=k)): rng.randint(1, 99) for _ in range(200_000)}
    save(path, counts, k, 8, db.SINGLE)
    size, read = 0, 0

    class Counting:
        def __init__(self, f):
            self.f = f

        def size(self):
            return self.f.size()

        def read_at(self, n, at):
            nonlocal read
            read += n
            return self.f.read_at(n, at)

    info = db.read_info(path)
    with db._open(f"{path}.kmc_pre") as pre, db._open(f"{path}.kmc_suf") as suf:
        size = suf.size()
        asked = rng.sample(sorted(counts), 1000)
        assert db._found(pre, Counting(suf), path, info, None, asked, None, None) == [counts[w] for w in asked]
    assert 20 * read < size


def test_counts_outside_of_the_range_are_not_listed(spark, tmp_path):
    counts, path = table(9, 300, most=100), str(tmp_path / "s")
    save(path, counts, 9, 1, limits=(10, 90))
    assert {r["kmer"]: r["cnt"] for r in db.read_database(spark, path).collect()} == {w: c for w, c in counts.items() if 10 <= c <= 90}
    assert {r["kmer"]: r["cnt"] for r in db.read_database(spark, path, 20, 30).collect()} == {w: c for w, c in counts.items() if 20 <= c <= 30}
    assert db.find_kmers(spark.createDataFrame([(w,) for w in counts], "kmer string"), path).where("cnt is not null").count() == sum(10 <= c <= 90 for c in counts.values())


def test_a_hundred_databases_are_one_scan(spark, tmp_path):
    tables = {}
    for n in range(100):
        name = f"{'female' if n < 50 else 'male'}-{n}"
        tables[name] = table(9, 20, seed=n % 7)
        save(str(tmp_path / name), tables[name], 9, 1)
    found = {r["sample"]: (r["path"], r["grp"]) for r in db.discover_databases(spark, str(tmp_path)).collect()}
    assert set(found) == set(tables) and found["female-7"][1] == 1 and found["male-77"][1] == 2
    df = db.read_databases(spark, {s: p for s, (p, _) in found.items()})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Union" not in plan
    assert df.rdd.getNumPartitions() < 10
    got = {}
    for r in df.collect():
        got.setdefault(r["sample"], {})[r["kmer"]] = r["cnt"]
    assert got == tables


def test_the_job_from_databases_is_the_job_from_reads(spark, tmp_path):
    """Databases with the counts of read files give the same tables as the read files."""
    import gzip

    rng = random.Random(8)
    genome = ["".join(rng.choices("ACGT", k=150)) for _ in range(2)]
    for group, g in (("females", 0), ("males", 1)):
        (tmp_path / group).mkdir()
        for n in range(5):
            seqs = [genome[g], genome[g], genome[0][:60]] if n else [genome[g], genome[g]]
            text = "".join(f"@r{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(seqs))
            (tmp_path / group / f"{n}_1.fq.gz").write_bytes(gzip.compress(text.encode()))
    settings = Settings(k=13, min_count=2, p_cut=0.05)
    one = run_association(spark, str(tmp_path), str(tmp_path / "reads"), settings)
    (tmp_path / "dbs").mkdir()
    counts = spark.read.parquet(str(tmp_path / "reads" / "counts")).withColumn("kmer", counting.kmer_text("kmer", 13)).collect()
    for sample in {r["sample"] for r in counts}:
        save(str(tmp_path / "dbs" / sample), {r["kmer"]: r["cnt"] for r in counts if r["sample"] == sample}, 13, 1)
    two = run_databases(spark, str(tmp_path / "dbs"), str(tmp_path / "out"), settings)
    assert one == two and one["significant"] > 50
    for name in ("matrix", "significant", "contigs"):
        first, second = (sorted(r["value"] for r in spark.read.text(str(tmp_path / x / name)).collect()) for x in ("reads", "out"))
        assert first == second
    with pytest.raises(ValueError, match="not 12"):
        run_databases(spark, str(tmp_path / "dbs"), str(tmp_path / "x"), Settings(k=12))
    assert table_header(spark, str(tmp_path / "out" / "matrix")).startswith("kmer\tfemale-0")
