"""Extendible hashing against its definition, with limits small enough to split often."""

import hashlib

from pyspark.sql import functions as F

from footings.llm.sharding import assign_shards, directory, write_shards


def brute(rows, limit):
    """Rows are distinct in key and text together."""
    cells = {}
    hashed = []
    for k, t in rows:
        name = f"{'' if k is None else k}:{hashlib.md5((t or '').encode()).hexdigest()}"
        hashed.append((k, len((t or "").encode()), f"{int(hashlib.md5(name.encode()).hexdigest()[:15], 16):060b}"))
    for _, n, h in hashed:
        for d in range(61):
            cells[h[:d]] = cells.get(h[:d], 0) + n
    return sorted((repr(k), n, next(h[:d] for d in range(61) if cells[h[:d]] <= limit or d == 60)) for k, n, h in hashed), cells


def check(docs, limit):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, cells = brute(rows, limit)
    got = assign_shards(docs, limit).collect()
    assert sorted((repr(r["doc_id"]), r["n_bytes"], r["shard"]) for r in got) == want
    for r in got:
        assert r["depth"] == len(r["shard"]) and r["shard_bytes"] == cells[r["shard"]]
        assert r["oversize"] == (r["shard_bytes"] > limit)
    return got


def test_splits_only_what_is_too_large(documents):
    for limit in (20_000, 100_000, 1 << 26):
        got = check(documents, limit)
        assert not any(r["oversize"] for r in got)
    assert {r["shard"] for r in got} == {""}


def test_more_than_one_pass_over_the_directory(documents):
    got = check(documents, 1000)
    # Documents above the limit end alone at full depth, the others never do.
    assert all((r["n_bytes"] > 1000) == r["oversize"] == (r["depth"] == 60) for r in got)


def test_odd_rows(odd_documents, no_documents):
    distinct = odd_documents.dropDuplicates(["doc_id", "text"]).filter("coalesce(text, '') != '' or doc_id = 2").cache()
    check(distinct, 50_000)
    check(distinct, 0)
    assert assign_shards(odd_documents, 100).count() == 11
    assert assign_shards(no_documents).count() == 0


def test_null_and_repeated_ids_keep_the_limit(spark):
    rows = [(None, f"{k:04d}" + "x" * 996) for k in range(50)] + [(5, "a" * 900), (5, "b" * 900)] + [(6, "c" * 500)] * 20 + [(None, "d" * 400)] * 20
    got = assign_shards(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), 1500).collect()
    assert len(got) == len(rows) and not any(r["oversize"] for r in got)
    held = {}
    for r in got:
        held[r["shard"]] = held.get(r["shard"], 0) + r["n_bytes"]
    assert all(r["shard_bytes"] == held[r["shard"]] <= 1500 for r in got)


def test_written_shards_hold_every_row(spark, documents, tmp_path):
    write_shards(documents, str(tmp_path / "shards"), 100_000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == documents.count()
    assert back.select("shard").distinct().count() > 3


def test_directory_lists_few_cells_below_a_crowded_one(spark):
    # 40 cells of 12 bits hold 100 rows each: 18 bits are needed, but no 2**12 cells below each.
    number = F.shiftleft(F.col("id") % 40, 48) + F.shiftleft(F.col("id"), 36)
    rows = spark.range(4000).select(number.alias("_hash"), F.lit(1).cast("bigint").alias("n_bytes"))
    leaves, ends = directory(rows, 2)
    cells = [2 ** (next(e for e in ends if e >= r["cell_depth"]) - r["cell_depth"]) for r in leaves.collect() if r["cell_depth"] > 12]
    assert sum(cells) <= 16 * leaves.count()


def test_a_large_document_alone_ends_the_passes(spark):
    rows = spark.createDataFrame([(1 << 59, 9), (3, 9), (1 << 50, 1)], "_hash bigint, n_bytes bigint")
    leaves, ends = directory(rows, 5)
    assert ends == [12]
    assert sorted((r["depth"], r["shard_bytes"], r["oversize"]) for r in leaves.collect()) == [(10, 1, False), (60, 9, True), (60, 9, True)]
