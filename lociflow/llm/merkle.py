"""A Merkle manifest of a dataset: a tree for each language, one over their roots, and a proof for every row by pointer jumping.

Leaves are numbered in order in two levels (sorted ranges, then a row for each range and language), so that a language isn't one
task's work. A level of the tree is an aggregation of eight neighbours. Each inner node then holds a segment of the proofs
that go through it (its run of children, and its own place among its siblings) and points at its parent; joining the nodes with
themselves doubles the distance of the ancestor that they point at and appends the ancestor's segment to theirs, until every
node has reached the root: as many rounds as the depth has binary digits. A leaf then joins its parent once. Nodes that have
arrived don't join again, and what is pointed at thins out by eight a level, so no join meets more rows than there are nodes.

Digests are binary inside and hexadecimal text where they're hashed.

Defined results: null fields are leaves' `-`; an empty text is `0:`; a null language is a language of its own and the first; rows
without doc_id are their language's first; rows that repeat a doc_id are leaves of their own in the order of their digests,
equal ones in any order, since they can't be told apart; a table of one row has its leaf as root and a proof of nothing; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import LOWER, UPPER, counted, stored

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE, UP = ["tree", "level", "idx"], ["up_tree", "up_level", "up_idx"]
#: The tree over the languages' roots.
TOP = -1


def leaf(**changed: Column) -> Column:
    """The digest of a row of documents, in hexadecimal; `changed` takes the place of columns."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds idx, a row's place in its group from 0, and n, the group's rows. Sorted ranges hold neighbours; places in them need one row
    for each range and group."""
    keys = [*group, *order]
    ranges = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)))
    own = ranges.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_here"))
    all_ranges = Window.partitionBy(*(group or [F.lit(0)]))
    own = own.withColumn("_before", F.sum("_here").over(all_ranges.orderBy("_range")) - F.col("_here")).withColumn("n", F.sum("_here").over(all_ranges))
    own = own.select(F.col("_range").alias("_r"), *(F.col(c).alias(f"_{c}") for c in group), "_first", "_before", "n")
    same = F.col("_range") == F.col("_r")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return ranges.join(own, same).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).select(*rows.columns, "idx", "n")


def _grown(nodes: DataFrame) -> list[DataFrame]:
    """The levels above nodes(tree, level, idx, n, hash), with each node's run of children. n: the tree's nodes in that level."""
    levels: list[DataFrame] = []
    while True:
        kids = F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("kids")
        up = nodes.where("n > 1").groupBy("tree", (F.col("level") + 1).alias("level"), F.floor(F.col("idx") / FAN).alias("up"), "n").agg(kids)
        run = F.array_join(F.transform("kids", lambda k: _hex(k["hash"])), "")
        up = up.select("tree", "level", F.col("up").alias("idx"), F.ceil(F.col("n") / FAN).alias("n"), F.unhex(F.sha2(run, 256)).alias("hash"), F.unhex(run).alias("run"))
        nodes, seen = counted(up)
        if not seen["rows"]:
            return levels
        levels.append(nodes)


def _pointed(nodes: DataFrame, trees: int) -> DataFrame:
    """Adds the parent, and pos, the place among its children."""
    inner, top = F.col("n") > 1, (F.col("tree") != TOP) & F.lit(trees > 1)
    child = F.when(inner, F.col("idx")).when(top, F.col("tree"))
    return nodes.withColumns(
        {
            "up_tree": F.when(inner, F.col("tree")).when(top, F.lit(TOP)).cast("long"),
            "up_level": F.when(inner, F.col("level") + 1).when(top, F.lit(1)),
            "up_idx": F.floor(child / FAN),
            "pos": F.pmod(child, F.lit(FAN)).cast("int"),
        }
    )


def _jumped(nodes: DataFrame) -> DataFrame:
    """Of every inner node: path, its segments (run, pos) up to the root, and subroot, its language's root."""
    own = F.array(F.struct("run", "pos"))
    subroot = F.when((F.col("n") == 1) & (F.col("tree") != TOP), F.col("hash"))
    paths, seen = counted(nodes.select(*NODE, *UP, own.alias("path"), subroot.alias("subroot")), going=F.col("up_tree").isNotNull().cast("int"))
    least = 2  # the lowest level of a language's tree that is pointed at
    while seen["going"]:
        ahead = paths.where((F.col("level") >= least) | (F.col("tree") == TOP))
        ahead = ahead.select(*(F.col(c).alias(u) for c, u in zip(NODE, UP, strict=True)), *(F.col(u).alias(f"_{u}") for u in UP), F.col("path").alias("_path"), F.col("subroot").alias("_subroot"))
        going = paths.where(F.col("up_tree").isNotNull()).join(ahead, UP)
        going = going.select(*NODE, *(F.col(f"_{u}").alias(u) for u in UP), F.concat("path", "_path").alias("path"), F.coalesce("subroot", "_subroot").alias("subroot"))
        paths, seen = counted(going.union(paths.where(F.col("up_tree").isNull())), going=F.col("up_tree").isNotNull().cast("int"))
        least = 2 * least - 1
    return paths


def folded(leaf_hex: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf_hex, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf's to the root's."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(docs: DataFrame, **more: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, and proof: of each level the siblings before and after, as hexadecimal text. `more`: further
    columns of documents' own, which go along."""
    rows = docs.select("doc_id", "lang", F.unhex(leaf()).alias("hash"), *(c.alias(f"more_{k}") for k, c in more.items()))
    rows = numbered(stored(rows), ["lang"], ["doc_id", "hash"])
    trees = numbered(rows.where("idx = 0").select("lang"), [], ["lang"]).select(F.col("lang").alias("_lang"), F.col("idx").alias("tree"))
    leaves, seen = counted(rows.join(trees, F.col("lang").eqNullSafe(F.col("_lang"))).drop("lang", "_lang").withColumn("level", F.lit(0)), trees=(F.col("idx") == 0).cast("int"))
    several = seen["trees"] > 1

    plain = ["tree", "level", "idx", "n", "hash"]
    levels = _grown(leaves.select(*plain))
    roots = leaves.where("n = 1").select(*plain)
    for nodes in levels:
        roots = roots.union(nodes.where("n = 1").select(*plain))
    roots = roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(seen["trees"]).cast("long").alias("n"), "hash")
    above = _grown(roots) if several else []
    last = above[-1] if above else roots
    root = last.select(_hex(F.col("hash"))).first()

    places = _pointed(leaves, seen["trees"])
    inner = [*levels, *above]
    if inner:
        all_nodes = inner[0]
        for nodes in inner[1:]:
            all_nodes = all_nodes.union(nodes)
        paths = _jumped(_pointed(all_nodes, seen["trees"]))
    else:  # one row or none
        paths = places.select(*NODE, F.array(F.struct(F.col("hash").alias("run"), "pos")).alias("path"), F.col("hash").alias("subroot")).where("false")
    paths = paths.select(*(F.col(c).alias(u) for c, u in zip(NODE, UP, strict=True)), "path", "subroot")
    out = places.join(paths, UP, "left")
    # A segment's own place tells where the next run is parted.
    at = F.concat(F.array("pos"), F.transform("path", lambda s: s["pos"]))
    size = 32
    parted = F.transform(
        F.arrays_zip(F.col("path").alias("path"), F.slice(at, 1, F.size("path")).alias("at")),
        lambda s: F.struct(
            _hex(s["path"]["run"].substr(F.lit(1), s["at"] * size)).alias("before"),
            _hex(s["path"]["run"].substr((s["at"] + 1) * size + 1, F.lit(FAN * size))).alias("after"),
        ),
    )
    proof = F.coalesce(parted, F.array().cast("array<struct<before:string,after:string>>"))
    subroot = F.when(F.col("n") == 1, F.col("hash")).otherwise(F.col("subroot"))
    return out.select("doc_id", _hex(F.col("hash")).alias("leaf"), _hex(subroot).alias("subroot"), F.lit(root[0] if root else None).cast("string").alias("root"), proof.alias("proof"), *(F.col(f"more_{k}").alias(k) for k in more))


def tampering(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and whether each row is verified after every third one's text (by a hash of doc_id) was lower-cased."""
    changed = F.unhex(leaf(text=F.translate("text", UPPER, LOWER)))
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = manifest(docs, changed=F.when(third, changed))
    found = folded(F.coalesce(_hex(F.col("changed")), F.col("leaf")), F.col("proof"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), found.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
