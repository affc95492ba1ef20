"""Merkle manifest of a table: a hash tree per language and one over their roots, with a proof per row.

Every node carries the interval of leaf ranks it covers. Levels are built and attached in bands, and a band's nodes are cut into
blocks that lie below one node at the band's top, so that a group holds 2^BAND nodes at most, however large a tree is.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.workspace import settle

#: Levels of a band.
BAND = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, size bigint, level int, lo bigint, hi bigint, digest string"
STEP = "array<struct<level: int, before: string, after: string>>"
PROOF = "leaf string, proof_sha256 string, folded string, subroot string, root string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(*values: Column) -> Column:
    """Hash of the values in order, each as its UTF-8 byte count, a colon and itself; null as a dash."""
    text = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered(id: Column) -> Column:
    """Whether 7 divides the crc32 of the decimal id; not so for null."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


# ---------------------------------------------------------------- ranks


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds `size` of the row's tree and its rank `lo` there, by `order`, nulls first. Needs `tree`.

    Rows are sorted by ranges over all trees, so a hot tree is spread, and numbered from the counts of the ranges before.
    A number of its own per row divides repeated rows among ranges as well.
    """
    # Read back, the numbers no longer depend on how rows were dealt to tasks.
    leaves = settle(leaves.withColumn("_n", F.monotonically_increasing_id()), "leaves")
    keys = ["tree", *order, "_n"]
    placed = settle(leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).drop("_n"), "ranges")
    part = F.shiftright("_at", 33).alias("_part")
    counts = placed.groupBy("tree", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # As many rows as ranges and trees together.
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    offsets = counts.select("tree", "_part", F.sum("_rows").over(Window.partitionBy("tree")).alias("size"), offset.alias("_offset"))
    joined = placed.withColumn("_part", F.shiftright("_at", 33)).join(settle(offsets, "offsets"), ["tree", "_part"])
    return joined.withColumn("lo", F.col("_at") + F.col("_offset")).drop("_part", "_at", "_offset")


# ---------------------------------------------------------------- building


def parents(nodes: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """One level up: two successive nodes (lo, hi, digest), or the one that is left, become one that covers both."""
    pairs = (nodes[i : i + 2] for i in range(0, len(nodes), 2))
    return [(run[0][0], run[-1][1], sha("".join(n[2] for n in run))) for run in pairs]


def _in_order(table: pa.Table) -> pa.Table:
    return table.take(pa.compute.sort_indices(table, sort_keys=[("lo", "ascending")]))


def band_above(nodes: DataFrame, level: int, tops_only: bool = False) -> DataFrame:
    """The nodes of the BAND levels above nodes of one level, or only the uppermost of each block. A tree ends at its root."""
    tree = nodes.withColumn("block", F.shiftright("lo", level + BAND))

    def build(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        name, size = table["tree"][0].as_py(), table["size"][0].as_py()
        row = list(zip(*(table[c].to_pylist() for c in ("lo", "hi", "digest")), strict=True))
        made, at = [], level
        while at < level + BAND and not (row[0][0] == 0 and row[0][1] == size):
            row, at = parents(row), at + 1
            made += [(at, *n) for n in row]
        if tops_only:
            made = [(at, *row[0])]
        columns = list(zip(*made, strict=True)) if made else [[], [], [], []]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array([name] * len(made), pa.string()), pa.array([size] * len(made), pa.int64())]
        return pa.table(arrays + [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["tree", "size", "level", "lo", "hi", "digest"])

    return tree.groupBy("tree", "block").applyInArrow(build, NODE)


# ---------------------------------------------------------------- attaching


def siblings(nodes: DataFrame) -> DataFrame:
    """Per node below a root: what its parent covers before and after it, as the digests of the nodes there.

    The children of a parent are those whose intervals its own contains: at most two by the bucket of their level.
    """
    below = nodes.where("not (lo = 0 and hi = size)").withColumn("bucket", F.expr("shiftright(lo, level + 1)"))
    family = below.groupBy("tree", "level", "bucket").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("family"))
    own = family.select("tree", "level", "family", F.inline("family").alias("lo", "hi", "digest"))
    side = lambda keep: F.array_join(F.transform(F.filter("family", keep), lambda n: n["digest"]), "")
    return own.select("tree", "level", "lo", "hi", side(lambda n: n["hi"] <= F.col("lo")).alias("before"), side(lambda n: n["lo"] >= F.col("hi")).alias("after"))


def paths_in_band(nodes: DataFrame, level: int) -> DataFrame:
    """`tree`, `lo`, `path` for each node at `level` that is no root: the siblings of itself and its ancestors below level +
    BAND, by level. Nodes meet their ancestors by (tree, level, bucket of that level), then by containment."""
    bottom = nodes.where(F.col("level") == level).where("not (lo = 0 and hi = size)")
    asked = bottom.select("tree", "lo", "hi", F.explode(F.sequence(F.lit(level), F.lit(level + BAND - 1))).alias("level"))
    asked = asked.withColumn("bucket", F.expr("shiftright(lo, level)"))
    held = siblings(nodes.where(F.col("level") < level + BAND)).withColumn("bucket", F.expr("shiftright(lo, level)"))
    held = held.withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    found = asked.join(held, ["tree", "level", "bucket"]).where("_lo <= lo and hi <= _hi")
    step = F.struct("level", "before", "after")
    return found.groupBy("tree", "lo").agg(F.array_sort(F.collect_list(step)).alias("path"))


def forest(leaves: DataFrame) -> DataFrame:
    """`tree`, `lo`, `path`, `root` per leaf (tree, size, lo, digest); `path` has a step per level up to the tree's root."""
    height = max(0, (leaves.agg(F.coalesce(F.max("size"), F.lit(1)).alias("n")).first()["n"] - 1).bit_length())
    bottom = settle(leaves.select("tree", "size", F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), "digest"), "nodes")
    bands = []
    for level in range(0, max(1, height), BAND):
        nodes = settle(bottom.unionByName(band_above(bottom, level)), "nodes")
        bands.append((level, nodes))
        bottom = nodes.where(F.col("level") == level + BAND).where("not (lo = 0 and hi = size)")
    # A root stands in one band only: the next one begins without it.
    roots = bands[0][1].where("lo = 0 and hi = size")
    for _, nodes in bands[1:]:
        roots = roots.unionByName(nodes.where("lo = 0 and hi = size"))
    above = None
    for level, nodes in reversed(bands):
        at = nodes.where(F.col("level") == level).select("tree", "lo")
        paths = at.join(paths_in_band(nodes, level), ["tree", "lo"], "left").withColumn("path", F.coalesce("path", F.array().cast(STEP)))
        if above is not None:
            upper = above.select("tree", F.col("lo").alias("_top"), F.col("path").alias("_above"))
            paths = paths.withColumn("_top", F.expr(f"shiftleft(shiftright(lo, {level + BAND}), {level + BAND})")).join(upper, ["tree", "_top"], "left")
            paths = paths.select("tree", "lo", F.concat("path", F.coalesce("_above", F.array().cast(STEP))).alias("path"))
        above = settle(paths, "paths")
    return above.join(roots.select("tree", F.col("digest").alias("root")), "tree")


# ---------------------------------------------------------------- proofs


def climb(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf leads to by the siblings before and after it on each level."""
    for before, after in path:
        digest = sha(before + digest + after)
    return digest


def _proofs(key, leaves: pa.Table, above: pa.Table) -> pa.Table:
    """Proofs of one block of leaves: its levels are built again, the rest of the path is the same for all of them."""
    leaves, top = _in_order(leaves), above.to_pylist()[0]
    rest = [(step["before"], step["after"]) for step in top["path"]]
    row = [(lo, lo + 1, d) for lo, d in zip(leaves["lo"].to_pylist(), leaves["digest"].to_pylist(), strict=True)]
    size = leaves["size"][0].as_py()
    steps: list[list[tuple[str, str]]] = [[] for _ in row]
    first = row[0][0]
    for _ in range(BAND):
        if row[0][0] == 0 and row[0][1] == size:
            break
        up = parents(row)
        for parent in up:
            inside = [n for n in row[parent[0] - first >> len(steps[parent[0] - first]) :][:2] if parent[0] <= n[0] and n[1] <= parent[1]]
            for node in inside:
                step = ("".join(n[2] for n in inside if n[1] <= node[0]), "".join(n[2] for n in inside if n[0] >= node[1]))
                for leaf in range(node[0] - first, node[1] - first):
                    steps[leaf].append(step)
        row = up
    proofs, folded = [], []
    for own, changed, path in zip(leaves["digest"].to_pylist(), leaves["tampered"].to_pylist(), steps, strict=True):
        path = path + rest
        proofs.append(sha("".join(before + after for before, after in path)))
        folded.append(climb(own if changed is None else changed, path))
    n = len(proofs)
    columns = [leaves["id"], leaves["digest"], pa.array(proofs), pa.array(folded), pa.array([top["subroot"]] * n), pa.array([top["root"]] * n)]
    return pa.table(columns, ["id", *(f.split()[0] for f in PROOF.split(", "))])


def manifest(
    docs: DataFrame, id: str = "doc_id", fields: tuple[str, ...] = FIELDS, by: str = "lang", counter: str = "n_chars", check: Column | None = None
) -> DataFrame:
    """`id`, leaf, subroot, root, proof_sha256, folded_root and verified per row.

    A tree per value of `by` (null is one of its own, before the empty text), leaves by id, null ids first; rows with
    equal ids stand in the order of their leaf hashes, so repeated rows have a place and proof each, and which of them
    has which makes no difference. `check` marks the rows whose proof is tried on a changed `counter` (plus 1; null stays
    null). Columns beyond `fields` are not covered. An empty table gives no rows.
    """
    column = lambda c: F.col(f"`{c}`")
    check = tampered(column(id)) if check is None else check
    # Wider than the counter, which may stand at its type's end.
    moved = {counter: column(counter).cast("decimal(38,0)") + 1}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), column(by)), F.lit("")).alias("tree"),
        column(id).alias("id"),
        leaf_hash(*map(column, fields)).alias("digest"),
        F.when(check, leaf_hash(*(moved.get(c, column(c)) for c in fields))).alias("tampered"),
    )
    leaves = settle(ranked(rows, ["id", "digest"]), "ranked")
    blocked = leaves.withColumn("block", F.shiftright("lo", BAND))
    tops = band_above(leaves.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest"), 0, tops_only=True)
    tops = settle(tops.select("tree", F.expr(f"shiftright(size - 1, {BAND}) + 1").alias("size"), F.shiftright("lo", BAND).alias("lo"), "digest"), "blocks")
    below = settle(forest(tops), "forest")
    subroots = below.where("lo = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    subroots = settle(ranked(subroots, ["name"]), "subroots")
    over = subroots.select("name", "lo").join(forest(subroots.select("tree", "size", "lo", "digest")).withColumnRenamed("path", "_above"), "lo")
    above = below.withColumnRenamed("root", "subroot").join(over.select(F.col("name").alias("tree"), "_above", "root"), "tree")
    above = above.select("tree", F.col("lo").alias("block"), F.concat("path", "_above").alias("path"), "subroot", "root")
    kind = rows.schema["id"].dataType.simpleString()
    proofs = blocked.groupBy("tree", "block").cogroup(settle(above, "above").groupBy("tree", "block")).applyInArrow(_proofs, f"id {kind}, {PROOF}")
    return proofs.select(
        F.col("id").alias(id), "leaf", "subroot", "root", "proof_sha256", F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified")
    )
