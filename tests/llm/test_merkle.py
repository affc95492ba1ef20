"""Merkle manifests against a tree built plainly."""

import hashlib
import zlib

from pyspark.sql import functions as F

from tandem.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, moved=0):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    values = [v + moved if i == 3 and v is not None else v for i, v in enumerate(values)]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, at):
    for row in tree[:-1]:
        other = at ^ 1
        yield (row[other] if other < at else ""), (row[other] if at < other < len(row) else "")
        at //= 2


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {x: sorted((r for r in rows if r["lang"] == x), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in order[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    for i, lang in enumerate(langs):
        for j, row in enumerate(order[lang]):
            steps = [*path(trees[lang], j), *path(top, i)]
            wrong = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            folded = leaf(row, int(wrong))
            for before, after in steps:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in steps))
            yield row["doc_id"], leaf(row), trees[lang][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def check(docs, rows=None):
    rows = [r.asDict() for r in docs.collect()]
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert ordered(got.collect()) == ordered(brute(rows))


def test_edge_rows(edges):
    check(edges)


def test_columns_with_names_used_inside(edges, clashing):
    wider = clashing.select("*", *(F.lit(1).alias(c) for c in ("tree", "lo", "hi", "size", "level", "block", "path", "leaf", "_n", "_part", "_at")))
    assert ordered(merkle.manifest(wider).collect()) == ordered(merkle.manifest(edges).collect())


def test_no_rows(nothing):
    assert merkle.manifest(nothing).collect() == []


def test_sizes_around_a_block(spark):
    sizes = spark.createDataFrame([(1,), (2,), (3,), (1024,), (1025,), (2500,)], "n bigint")
    rows = sizes.selectExpr("n", "explode(sequence(1, n)) id")
    check(rows.selectExpr("id doc_id", "'s' source", "concat('l', n) lang", "id n_chars", "concat('t', id) text"))


def test_many_bands_and_trees(spark, monkeypatch):
    """Bands of two levels, trees of 1 to 40 leaves, with and without a language, ids that repeat or are null, a group of copies."""
    monkeypatch.setattr(merkle, "BAND", 2)
    rows = [(i if i % 9 else None, f"x{i % 50}", [None, "", "é", "en", "z"][min(4, i % 11)], "s", i) for i in range(80)]
    rows += [(7, "copy", "en", "s", 2**63 - 1)] * 12
    check(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))


def test_a_changed_row_fails_its_proof_only(spark):
    docs = spark.range(300).selectExpr("id doc_id", "'s' source", "if(id % 3 = 0, 'en', 'de') lang", "id n_chars", "'t' text")
    got = merkle.manifest(docs, check=F.col("doc_id").isin(5, 60)).where("not verified").select("doc_id")
    assert sorted(r[0] for r in got.collect()) == [5, 60]
    before, after = (merkle.manifest(d, check=F.lit(False)).select("root").distinct().collect() for d in (docs, docs.where("doc_id <> 17")))
    assert len(before) == len(after) == 1 and before != after


def test_no_group_exceeds_a_block(spark):
    """A tree of 5,000 leaves: siblings are attached in groups of at most 2^BAND nodes, however large the tree."""
    nodes = merkle.settle(spark.range(5000).selectExpr("'t' tree", "5000L size", "0 level", "id lo", "id + 1 hi", "cast(id as string) digest"), "nodes")
    band = merkle.settle(nodes.unionByName(merkle.band_above(nodes, 0)), "band")
    assert band.groupBy(F.expr("shiftright(lo, 10)"), "level").count().agg(F.max("count")).first()[0] == 1024
    steps = merkle.paths_in_band(band, 0).select(F.size("path").alias("n")).groupBy("n").count().collect()
    assert [(r["n"], r["count"]) for r in steps] == [(merkle.BAND, 5000)]
