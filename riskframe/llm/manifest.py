"""Merkle dataset manifest on nested-interval labels: leaf digests, roots, and a proof for every row.

**Leaves.** A row's leaf is the SHA-256 of its fields. The leaves of a source are ranked from 0 by id; a node carries the
interval [lo, hi) of leaf ranks that it covers, so a node's ancestors are the nodes whose intervals contain its own, and
its siblings are the parent's interval less its own. No node names another.

**Levels.** Every three consecutive nodes become one until a source has one node left. The nodes of ``BAND`` levels that
lie in one interval of 3^BAND units are a block (a bucket of levels): one ``groupBy`` on (tree, block) builds it from its
units, at most 3^BAND of them, and its last node is a unit of the next band. So the tables shrink by 27 from band to band,
and a source with a third of all rows is as many blocks as it needs. The sources' roots, in the order of their names, are
the leaves of one more tree of the same kind.

**Proofs.** From the top band down, the units of a band join the blocks of that band by containment (tree, block, lo <=
rank < hi). In a block, the node of each level that contains the rank is found by its interval, its siblings by the
difference of the parent's interval and its own; the steps above the block come with the block. At the end every row has
its steps, each the digests left and right of its path, and folds them with its own leaf to a root.

Everything is DataFrame functions. Rows that travel hold ids, ranks and digests, never texts.

Defined results: null fields are ``-`` in the leaf; a null source is a source of its own, the first one; null ids rank
before all others and are never tampered; rows that share source and id rank by their leaf, and rows alike in all fields
get leaves alike, each at its own rank; empty and very long texts are hashed like any other; an empty table gives an
empty result; other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import table
from riskframe.llm.registry import register
from riskframe.operators.ordering import row_index
from riskframe.session import materialize

#: Children of a node, and levels of a block.
FAN, BAND = 3, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return digest(F.concat(*parts))


def blocks_of(units: DataFrame) -> DataFrame:
    """tree, block, n0 .. nBAND (the nodes of each level, in order), grows (the tree has more units than this block).

    ``units`` are tree, place (from 0 without gaps in each tree), lo, hi, digest. The unit that starts the second block
    tells the first one that there is another."""
    size = FAN**BAND
    block, node = F.floor(F.col("place") / size), F.struct("lo", "hi", "digest")
    own = F.struct(block.alias("block"), node.alias("node"))
    news = F.struct(F.lit(0).cast("bigint").alias("block"), F.lit(None).cast("struct<lo:bigint,hi:bigint,digest:string>").alias("node"))
    rows = units.select("tree", F.explode(F.when(F.col("place") == size, F.array(own, news)).otherwise(F.array(own))).alias("u"))
    out = rows.groupBy("tree", F.col("u.block").alias("block")).agg(
        F.sort_array(F.collect_list(F.col("u.node"))).alias("n0"), (F.bool_or(F.col("u.node").isNull()) | (F.col("block") > 0)).alias("grows")
    )
    for i in range(BAND):
        out = out.withColumn(f"n{i + 1}", parents(F.col(f"n{i}"), F.col("grows")))
    return out


def parents(nodes: Column, grows: Column) -> Column:
    """The next level of a block; a tree's last node stays what it is."""

    def parent(i: Column) -> Column:
        kids = F.slice(nodes, i * FAN + 1, FAN)
        hashed = digest(F.array_join(F.transform(kids, lambda k: k["digest"]), ""))
        return F.struct(F.element_at(kids, 1)["lo"].alias("lo"), F.element_at(kids, -1)["hi"].alias("hi"), hashed.alias("digest"))

    level = F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")), parent)
    return F.when(grows | (F.size(nodes) > 1), level).otherwise(nodes)


def bands_of(units: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of every band, from the leaves up; in the last one each tree is one block."""
    bands = []
    while True:
        blocks = materialize(blocks_of(units), f"{name}-band{len(bands)}")
        bands.append(blocks)
        if blocks.where("grows").isEmpty():
            return bands
        units = blocks.select("tree", F.col("block").alias("place"), *[F.element_at(f"n{BAND}", 1)[c].alias(c) for c in ("lo", "hi", "digest")])


def roots_of(bands: list[DataFrame]) -> DataFrame:
    """tree, subroot: one row for each tree."""
    return bands[-1].select("tree", F.element_at(f"n{BAND}", 1)["digest"].alias("subroot"))


def step(level: Column, above: Column, rank: Column, grows: Column) -> Column:
    """The step from the node of ``level`` that holds ``rank`` to its parent, as an array; empty where that is the root."""
    parent = F.element_at(F.filter(above, lambda p: (p["lo"] <= rank) & (rank < p["hi"])), 1)
    kin = F.filter(level, lambda k: (k["lo"] >= parent["lo"]) & (k["hi"] <= parent["hi"]))
    side = lambda keep: F.array_join(F.transform(F.filter(kin, keep), lambda k: k["digest"]), "")
    made = F.struct(side(lambda k: k["hi"] <= rank).alias("left"), side(lambda k: k["lo"] > rank).alias("right"))
    return F.when(grows | (F.size(level) > 1), F.array(made)).otherwise(F.array().cast(_STEPS))


def attach(units: DataFrame, blocks: DataFrame) -> DataFrame:
    """``units`` (tree, place, lo and others) with ``steps`` up to the root, ``subroot``; ``blocks`` have ``up``, the steps
    above them."""
    inner = [f"n{i}" for i in range(BAND + 1)]
    there = blocks.select(F.col("tree").alias("_t"), F.col("block").alias("_b"), "grows", "up", "subroot", *inner)
    here = (F.col("tree") == F.col("_t")) & (F.floor(F.col("place") / FAN**BAND) == F.col("_b"))
    top = F.element_at(f"n{BAND}", 1)
    here = here & (top["lo"] <= F.col("lo")) & (F.col("lo") < top["hi"])
    out = units.join(there, here)
    steps = [step(F.col(inner[i]), F.col(inner[i + 1]), F.col("lo"), F.col("grows")) for i in range(BAND)]
    return out.withColumn("steps", F.concat(*steps, F.col("up"))).drop("_t", "_b", "grows", "up", *inner)


def paths(units: DataFrame, bands: list[DataFrame], roots: DataFrame, name: str) -> DataFrame:
    """``units`` with steps and subroot. ``roots`` are tree, up (the steps above the tree's root), subroot."""
    above = bands[-1].join(roots, "tree")
    for i in range(len(bands) - 2, -1, -1):
        inside = bands[i].select("tree", F.col("block").alias("place"), F.element_at(f"n{BAND}", 1)["lo"].alias("lo"), *[f"n{j}" for j in range(BAND + 1)], "grows")
        inside = inside.select("tree", "place", "lo", F.struct(*[f"n{j}" for j in range(BAND + 1)], "grows").alias("mine"))
        joined = attach(inside, above).select("tree", F.col("place").alias("block"), "mine.*", F.col("steps").alias("up"), "subroot")
        above = materialize(joined, f"{name}-above{i}")
    return attach(units, above)


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` with place, lo and hi by (tree, doc_id, leaf, seen); nulls first."""
    out = row_index(leaves, [F.col("doc_id").asc_nulls_first(), "leaf", F.col("seen").asc_nulls_first()], ["tree"], "_m_place")
    return out.withColumns({"place": F.col("_m_place") - 1, "lo": F.col("_m_place") - 1, "hi": F.col("_m_place")}).drop("_m_place")


def manifest(docs: DataFrame, seen: Column | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, leaf, subroot, root, proof (array of steps), proof_sha256,
    folded_root, verified.

    ``fields`` name the id, the source and the other hashed columns, the text last. ``seen`` is the text that a reader was
    given, as an expression over ``docs`` (by default the text itself): ``folded_root`` comes from its leaf and the
    original siblings."""
    cols = [F.col(f"`{f}`") for f in fields]
    leaf = leaf_of(cols)
    shown = F.lit(None).cast("string") if seen is None else F.when(~seen.eqNullSafe(cols[-1]), leaf_of([*cols[:-1], seen]))
    source = cols[1].cast("string")
    tree = F.coalesce(F.concat(F.lit("s"), source), F.lit(""))  # in the order of the bytes, null first
    leaves = docs.select(cols[0].cast("bigint").alias("doc_id"), source.alias("source"), tree.alias("tree"), leaf.alias("leaf"), shown.alias("seen"))
    units = materialize(ranked(materialize(leaves, "manifest-leaves")), "manifest-units")
    bands = bands_of(units.select("tree", "place", "lo", "hi", F.col("leaf").alias("digest")), "manifest")

    tops = row_index(roots_of(bands).withColumnRenamed("subroot", "digest"), ["tree"], name="no")
    tops = tops.select(F.lit("").alias("tree"), (F.col("no") - 1).alias("place"), (F.col("no") - 1).alias("lo"), F.col("no").alias("hi"), "digest", F.col("tree").alias("of"))
    tops = materialize(tops, "manifest-subroots")
    top_bands = bands_of(tops.drop("of"), "manifest-top")
    whole = roots_of(top_bands).first()  # one row, or none
    root = whole["subroot"] if whole else None
    none = top_bands[-1].select("tree", F.array().cast(_STEPS).alias("up"), F.lit(root).cast("string").alias("subroot"))
    over = paths(tops, top_bands, none, "manifest-top").select(F.col("of").alias("tree"), F.col("steps").alias("up"), F.col("digest").alias("subroot"))

    out = paths(units, bands, materialize(over, "manifest-over"), "manifest")
    proof = F.array_join(F.flatten(F.transform("steps", lambda s: F.array(s["left"], s["right"]))), "")
    folded = F.aggregate("steps", F.coalesce("seen", "leaf"), lambda at, s: digest(F.concat(s["left"], at, s["right"])))
    out = out.withColumns({"root": F.lit(root).cast("string"), "proof_sha256": digest(proof), "folded_root": folded})
    out = out.select("doc_id", "source", "leaf", "subroot", "root", F.col("steps").alias("proof"), "proof_sha256", "folded_root")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """A reader's check of one row: the root that its leaf and its proof give."""
    from hashlib import sha256

    return reduce(lambda at, s: sha256((s[0] + at + s[1]).encode()).hexdigest(), proof, leaf)


#: CRC-32 of a short text by its bits, for an engine without that function.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, len(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT),
  lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


@register(
    "op13_merkle_manifest",
    f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf("text")} AS leaf,
             CASE WHEN (SELECT {_CRC} FROM (SELECT doc_id::VARCHAR AS s)) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS seen
      FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM d),
    t AS (
      SELECT tree, 0 AS level, place, leaf AS h, n FROM r
      UNION ALL
      SELECT tree, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 2) // 3
      FROM t WHERE n > 1 GROUP BY tree, level, place // 3),
    s AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
    u AS (
      SELECT 0 AS level, place, h, n FROM s
      UNION ALL
      SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 2) // 3 FROM u WHERE n > 1 GROUP BY level, place // 3),
    low AS (SELECT r.tree, r.place AS leaf_place, t.level, t.h, t.place FROM r JOIN t ON r.tree = t.tree AND t.n > 1 AND t.place // 3 = r.place // (3 ** (t.level + 1))::BIGINT),
    low_step AS (
      SELECT tree, leaf_place, level, coalesce(string_agg(h, '' ORDER BY place) FILTER (place < leaf_place // (3 ** level)::BIGINT), '') AS l,
             coalesce(string_agg(h, '' ORDER BY place) FILTER (place > leaf_place // (3 ** level)::BIGINT), '') AS g
      FROM low GROUP BY tree, leaf_place, level),
    high AS (SELECT s.tree, s.place AS sub_place, u.level, u.h, u.place FROM s JOIN u ON u.n > 1 AND u.place // 3 = s.place // (3 ** (u.level + 1))::BIGINT),
    high_step AS (
      SELECT tree, level, coalesce(string_agg(h, '' ORDER BY place) FILTER (place < sub_place // (3 ** level)::BIGINT), '') AS l,
             coalesce(string_agg(h, '' ORDER BY place) FILTER (place > sub_place // (3 ** level)::BIGINT), '') AS g
      FROM high GROUP BY tree, sub_place, level),
    steps AS (
      SELECT r.tree, r.place,
             coalesce((SELECT list({{'l': l, 'g': g}} ORDER BY level) FROM low_step x WHERE x.tree = r.tree AND x.leaf_place = r.place), [])
             || coalesce((SELECT list({{'l': l, 'g': g}} ORDER BY level) FROM high_step y WHERE y.tree = r.tree), []) AS p
      FROM r),
    f AS (
      SELECT r.doc_id, r.leaf, r.tree, list_reduce([coalesce(r.seen, r.leaf)] || list_transform(p, lambda x: x.l || '|' || x.g),
               lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2))) AS folded_root,
             sha256(array_to_string(list_transform(p, lambda x: x.l || x.g), '')) AS proof_sha256
      FROM r JOIN steps ON r.tree = steps.tree AND r.place = steps.place)
    SELECT f.doc_id, f.leaf, s.h AS subroot, u.h AS root, f.proof_sha256, f.folded_root, f.folded_root = u.h AS verified
    FROM f JOIN s ON f.tree = s.tree JOIN u ON u.n = 1
    """,
)
def op13_merkle_manifest(spark, sf_dir) -> DataFrame:
    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    return manifest(table(spark, sf_dir, "documents"), shown).drop("source", "proof")
