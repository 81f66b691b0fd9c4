"""Sample manifests: which files belong to which sample of which group."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUPS = ("females", "males")


def natural_key(name: str) -> list:
    """Sort key in which runs of digits compare as numbers."""
    return [(1, int(p), "") if p.isdigit() else (0, 0, p) for p in re.split(r"(\d+)", name) if p]


def sample_of(path: F.Column, groups: tuple[str, str] = GROUPS, prefix_group: bool = True) -> F.Column:
    """``group-id`` (or the id alone) of ``.../<group>/<id>_...``; the id ends at the next ``/`` or ``_``."""
    pattern = f"(?:^|/)({'|'.join(map(re.escape, groups))})/([^/_]+)"
    grp, name = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
    # A group's directory is plural, its samples' prefix is not.
    return F.when(name != "", F.concat(F.regexp_replace(grp, "s$", ""), F.lit("-"), name) if prefix_group else name)


def discover(spark: SparkSession, root: str, groups: tuple[str, str] = GROUPS, suffix: str = ".fq.gz", prefix_group: bool = True) -> DataFrame:
    """``(path, grp, sample)`` of the read files under ``root``, from file names only; group 1 is ``groups[0]``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root).select("path")
    grp = F.when(F.col("path").rlike(f"(?:^|/){re.escape(groups[0])}/"), 1).otherwise(2)
    named = files.select("path", grp.alias("grp"), sample_of(F.col("path"), groups, prefix_group).alias("sample"))
    return named.where("sample is not null")


def sample_order(manifest: DataFrame) -> list[str]:
    """Sample names, group 1 first, each group in natural order; one name per sample reaches the driver."""
    rows = manifest.select("grp", "sample").distinct().collect()
    return [r["sample"] for r in sorted(rows, key=lambda r: (r["grp"], natural_key(r["sample"])))]
