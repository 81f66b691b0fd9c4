import gzip
import random
import struct
import zlib

import pytest

from kmerloom.sources import blocked_gzip as source
from kmerloom.sources.reads import read_fastq


def block(data):
    """A gzip member with its length in its header."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def blocked(text, size):
    return b"".join(block(text[i : i + size]) for i in range(0, len(text), size)) + block(b"")


def fastq(n, seed=1, end="\n", most=300):
    """Records whose quality lines often start with @ or +."""
    rng = random.Random(seed)
    seqs = ["".join(rng.choices("ACGTN", k=rng.randint(1, most))) for _ in range(n)]
    return seqs, "".join(f"@r{i}{end}{s}{end}+{end}{''.join(rng.choices('@+AB#', k=len(s)))}{end}" for i, s in enumerate(seqs)).encode()


def read(path, split):
    reader = source._Reads([str(path)], split)
    parts = reader.partitions()
    return [s for p in parts for b in reader.read(p) for s in b.column(1).to_pylist()], len(parts)


@pytest.mark.parametrize("size", [50, 700, 5000, 60_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_read_every_record_once(tmp_path, size, end):
    seqs, text = fastq(600, end=end)
    (tmp_path / "a.gz").write_bytes(blocked(text, size))
    for split in (300, 2999, 50_000, 1 << 24):
        got, n = read(tmp_path / "a.gz", split)
        assert got == seqs and (n > 1 or split == 1 << 24 or n == -(-(tmp_path / "a.gz").stat().st_size // split))


def test_other_gzip_forms_are_read_by_one_task(tmp_path):
    seqs, text = fastq(500)
    for data in (gzip.compress(text), gzip.compress(text[:999]) + gzip.compress(text[999:]) + bytes(77), gzip.compress(b"") + gzip.compress(text)):
        (tmp_path / "a.gz").write_bytes(data)
        assert read(tmp_path / "a.gz", 500) == (seqs, 1)
    (tmp_path / "a.gz").write_bytes(gzip.compress(b""))
    assert read(tmp_path / "a.gz", 500)[0] == []
    for data in (gzip.compress(text)[:-9], gzip.compress(text)[:-9] + bytes(9), b"no gzip"):
        (tmp_path / "a.gz").write_bytes(data)
        with pytest.raises(ValueError):
            read(tmp_path / "a.gz", 500)


def test_damaged_blocks_are_refused(tmp_path):
    _, text = fastq(300)
    data = blocked(text, 3000)
    starts, at = [], 0
    while at < len(data):
        starts.append(at)
        at += source.block_length(data[at : at + 256])
    for k in starts[1:-3:3]:
        # Marks, lengths, and contents.
        for place in (0, 2, 13, 16, 30, 200):
            bad = bytearray(data)
            bad[k + place] ^= 0x55
            (tmp_path / "a.gz").write_bytes(bad)
            for split in (1000, 20_000):
                with pytest.raises(ValueError):
                    read(tmp_path / "a.gz", split)
    for cut in (10, 40, 1000):
        (tmp_path / "a.gz").write_bytes(data[:-cut])
        with pytest.raises(ValueError):
            read(tmp_path / "a.gz", 1000)


def test_one_large_file_is_many_tasks(spark, tmp_path):
    """A file of 20 MB of text is read by eight tasks and more, with the rows of the plain reader."""
    (tmp_path / "females").mkdir()
    _, text = fastq(40_000, most=400)
    (tmp_path / "females" / "s1_1.fq.gz").write_bytes(blocked(text, 60_000))
    (tmp_path / "females" / "s2_1.fq.gz").write_bytes(gzip.compress(fastq(50, 2)[1]))
    paths = [f"file:{tmp_path}/females/s{k}_1.fq.gz" for k in (1, 2)]
    df = source.read_blocked_fastq(spark, paths, split_bytes=1 << 19)
    plain = read_fastq(spark, paths)
    assert df.rdd.getNumPartitions() >= 9 and df.columns == plain.columns
    rows = [sorted((r["grp"], r["sample"], r["seq"]) for r in x.collect()) for x in (df, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 40_050
