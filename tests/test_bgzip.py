"""Block-gzip text: many tasks a file, lines across blocks, damage, and what is written can be read by any gzip reader."""

from __future__ import annotations

import gzip
import random

import pytest

from gridloom.sources import bgzip, io


def packed(text: bytes, sizes) -> bytes:
    """text in blocks of the given sizes, in turn."""
    out, at, i = b"", 0, 0
    while at < len(text):
        n = sizes[i % len(sizes)]
        out += bgzip.pack(text[at : at + n])
        at, i = at + n, i + 1
    return out + bgzip.END_OF_FILE


def test_ranges_give_every_line_once(tmp_path):
    r = random.Random(1)
    for case in range(60):
        some = ["".join(r.choice("abc\t") for _ in range(r.choice([0, 1, 5, 40, 900]))) for _ in range(r.randint(0, 80))]
        text = "\n".join(some).encode() + r.choice([b"", b"\n"])
        if text.endswith(b"\n") or not text:
            want = text.decode().split("\n")[:-1]
        else:
            want = text.decode().split("\n")
        p = tmp_path / f"{case}.bgz"
        p.write_bytes(packed(text, r.choice([[1, 7, 30], [100], [64, 1000], [5000]])))
        assert gzip.decompress(p.read_bytes()) == text
        size = p.stat().st_size
        for step in (1 if size < 3000 else 997, 57, 400, 10_000):
            got = [x for at in range(0, size, step) for part in bgzip.lines(str(p), at, min(at + step, size)) for x in part]
            assert got == want, (case, step)


def test_blocks_of_text_that_does_not_shrink():
    noise = random.Random(3).randbytes(bgzip.MOST_TEXT)
    block = bgzip.pack(noise)
    assert len(block) <= bgzip.MOST_BLOCK and bgzip.block_size(block[:64]) == len(block) and bgzip.unpack(block) == noise


def test_marks_inside_blocks_are_no_blocks(tmp_path):
    text = b"\n".join([bgzip.MAGIC.replace(b"\n", b"") + bytes([i]) for i in range(32, 120)] * 30)
    stored = [text[i : i + 500] for i in range(0, len(text), 500)]
    import struct
    import zlib

    def raw(t):
        c = zlib.compressobj(0, zlib.DEFLATED, -15)
        d = c.compress(t) + c.flush()
        return bgzip.MAGIC + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(d) + 25) + d + struct.pack("<II", zlib.crc32(t), len(t))

    p = tmp_path / "x.bgz"
    p.write_bytes(b"".join(map(raw, stored)) + bgzip.END_OF_FILE)
    size, got = p.stat().st_size, []
    for at in range(0, size, 333):
        f = bgzip.first_block(__import__("pyarrow").OSFile(str(p), "rb"), at, size)
        got.append(f)
    starts = [0]
    for t in stored:
        starts.append(starts[-1] + len(raw(t)))
    starts.append(size)
    assert all(f in starts for f in got) and got == sorted(got)


def test_source_and_sink(spark, tmp_path):
    want = [f"{i}\t" + "x" * (i % 300) for i in range(20_000)]
    bgzip.write_lines(spark.createDataFrame([(x,) for x in want], "value string").coalesce(3), str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*.bgz"))
    assert len(parts) == 3 and "".join(gzip.decompress(p.read_bytes()).decode() for p in parts).split("\n")[:-1] == want
    d = bgzip.read_lines(spark, [str(parts[0])], range_bytes=4000)
    one = gzip.decompress(parts[0].read_bytes()).decode().split("\n")[:-1]
    assert d.rdd.getNumPartitions() > 5 and [r[0] for r in d.select("value").collect()] == one
    assert sorted(r[0] for r in io.text_lines(spark, str(tmp_path / "out")).select("value").collect()) == sorted(want)
    bgzip.write_lines(spark.createDataFrame([("a",)], "value string"), "file://" + str(tmp_path / "out"))
    assert [r[0] for r in io.text_lines(spark, str(tmp_path / "out")).select("value").collect()] == ["a"]
    with pytest.raises(Exception, match="overwrite"):
        bgzip.write_lines(spark.createDataFrame([("b",)], "value string"), str(tmp_path / "out"), mode="append")


def test_damage_is_an_error(spark, tmp_path):
    whole = packed(b"abc\n" * 5000, [3000])
    (tmp_path / "short.bgz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "gz.bgz").write_bytes(gzip.compress(b"abc\n"))
    for name in ("short.bgz", "gz.bgz"):
        with pytest.raises(Exception, match="block"):
            bgzip.read_lines(spark, [str(tmp_path / name)]).collect()
    with pytest.raises(Exception, match="nowhere"):
        bgzip.read_lines(spark, [str(tmp_path / "nowhere.bgz")]).collect()


HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n"


def test_vcf_by_blocks(spark, tmp_path):
    body = "".join(f"chr1\t{i}\t.\tA\tC\t.\tPASS\t.\tGT\t0/1\n" for i in range(1, 1001))
    for name in ("x.vcf.bgz", "x.vcf.gz"):
        (tmp_path / name).write_bytes(packed((HEAD + body).encode(), [1000]))
    (tmp_path / "plain.vcf.gz").write_bytes(gzip.compress((HEAD + body).encode()))
    rows = []
    for path, force in (("x.vcf.bgz", False), ("x.vcf.gz", True), ("x.vcf.gz", False), ("plain.vcf.gz", False)):
        sites, samples, cells = io.read_vcf(spark, str(tmp_path / path), force_bgz=force)
        rows.append((sites.count(), samples.count(), cells.filter("n_alt = 1").count()))
    assert rows == [(1000, 1, 1000)] * 4
    sites, samples, cells = io.read_vcf(spark, str(tmp_path / "x.vcf.bgz"))
    io.export_vcf(sites, str(tmp_path / "o"), cells, samples, bgzip_shards=True)
    back, _, again = io.read_vcf(spark, str(tmp_path / "o/shards"), header=str(tmp_path / "o/header"))
    assert back.select("vid").exceptAll(sites.select("vid")).count() == 0 and again.count() == 1000
    (tmp_path / "no.vcf").write_text(body)
    with pytest.raises(ValueError, match="#CHROM"):
        io.read_vcf(spark, str(tmp_path / "no.vcf"))


def test_tables_by_blocks(spark, tmp_path):
    d = spark.createDataFrame([(i, None if i % 7 == 0 else f"n{i}", i / 4) for i in range(500)], "k long, s string, x double")
    io.export_table(d, str(tmp_path / "t"), compression="bgzip")
    got = [io.read_table(spark, str(p), types={"k": "bigint", "x": "double"}) for p in sorted((tmp_path / "t").glob("*.bgz"))]
    assert sorted((r["k"], r["s"], r["x"]) for g in got for r in g.collect()) == sorted(tuple(r) for r in d.collect())
    (tmp_path / "i.tsv.bgz").write_bytes(packed(b"a\tb\tc\n1\t2.5\tx\n3\t4\t\n", [9]))
    t = io.read_table(spark, str(tmp_path / "i.tsv.bgz"), impute=True)
    assert t.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")] and [tuple(r) for r in t.orderBy("a").collect()] == [(1, 2.5, "x"), (3, 4.0, None)]
    (tmp_path / "r.bed.bgz").write_bytes(packed(b"chr1\t0\t10\n", [4]))
    assert [tuple(r)[:3] for r in io.read_bed(spark, str(tmp_path / "r.bed.bgz")).collect()] == [("chr1", 1, 11)]
