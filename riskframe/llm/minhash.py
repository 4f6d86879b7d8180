"""MinHash near-dedup: fast similarity sketches, banding, exact verification, connected components.

**Sketch.** A sketch has t coordinates. In round i of the first t every element of the set is thrown into one of the t
bins by a hash of (round, element) and offers the value (round, hash); each bin keeps its smallest. After round r only
sets with an empty bin go on; rounds t, t+1, .. throw all elements into bin r - t, so every coordinate is filled after
at most 2t rounds. Two sets agree in a coordinate with probability equal to their similarity, and the number of
agreements concentrates as with independent hashes, at about t log t + n steps instead of t * n.

**Bands.** ``rows`` coordinates make a band; the number of bands is chosen so that a pair at the threshold is missed
with a probability below one in a million. Sets are first collapsed: documents with the same set are one node, named by
a 128-bit digest.

**Candidates.** A bucket (band and value) with m nodes never gives all pairs at first: one node is paired with each other
one, the node that meets most others over all its buckets (of edited copies, that is the text they come from, to which
each is more similar than to one another). What verification joins is one component. Nodes of buckets that still hold
*different* components then meet on their rare elements only (``rare_pairs``: prefixes in the order of rarity among these
nodes, exact for the threshold), and what meets is verified. So no link between different sets that share a bucket is lost,
a group of thousands of near copies costs one pair for each member, and edited copies that lie just below the threshold,
each with words of its own, don't meet at all.

**Verification** joins the full shingle sets of the paired nodes (recomputed from the text of one document of each) and
counts the intersection. Components take the smallest label over the links until nothing changes; each round is written
to the shared folder.

Defined results: A-Z in lower case, words as runs without white space; a text of fewer words than a shingle is one
shingle; texts without words (null, empty) have no set, link with nothing, and are their own component; rows with equal
ids and equal texts get equal answers; a null id takes the component's smallest id and is kept only where the component
has no other; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_text, table, unused
from riskframe.llm.registry import register
from riskframe.llm.shingles import WordHashes, mixed, shingle_set
from riskframe.session import materialize

ROWS = 8
MISS = 1e-6
#: Elements of the sets that are sketched together; hashes of words that a task keeps.
LOT, KEPT = 300_000, 200_000


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that a pair of just this similarity (in percent) shares none with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One row of t coordinates (uint64: round in the top 16 bits, value below) for each set, none of them empty; no row
    without sets."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(sets) * t, full, dtype=np.uint64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for r in range(2 * t):
        h = mixed(elements + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        bin_ = (h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32) if r < t else np.uint64(r - t)
        value = np.uint64(r << 48) | (mixed(h) >> np.uint64(16))
        np.minimum.at(out, owner * t + bin_.astype(np.int64), value)
        lacking = (out.reshape(len(sets), t) == full).any(axis=1)
        if not lacking.any():
            break
        go = lacking[owner]
        if not go.all():
            elements, owner = elements[go], owner[go]
    return out.reshape(len(sets), t)


def sketched(docs: DataFrame, words: int, t: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, node (digest of the set; null: none), bands (array of hashes), text_hash."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes(KEPT)
        for b in batches:
            column = b.column(1)
            start = 0
            while start < len(b):
                sets, total = [], 0
                while start + len(sets) < len(b) and total < LOT:
                    sets.append(shingle_set(column[start + len(sets)].as_py(), words, known))
                    total += len(sets[-1])
                some = [s for s in sets if len(s)]
                sk = sketches(some, t).reshape(len(some), t // rows, rows)
                band = np.zeros(sk.shape[:2], dtype=np.uint64)
                for i in range(rows):
                    band = mixed(band ^ sk[:, :, i])
                lists = iter(band.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(start, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(lists) if len(s) else None for s in sets], pa.list_(pa.int64())),
                        b.column(2).slice(start, len(sets)),
                    ],
                    ["doc_id", "n_shingles", "node", "bands", "text_hash"],
                )
                start += len(sets)

    texts = id_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return texts.mapInArrow(task, "doc_id bigint, n_shingles bigint, node binary, bands array<bigint>, text_hash bigint")


def full_sets(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, elements: the sorted shingle hashes of every text that has any."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes(KEPT)
        for b in batches:
            for start in range(0, len(b), 500):
                sets = [shingle_set(t.as_py(), words, known) for t in b.column(1).slice(start, 500)]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["node", "elements"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(task, "node binary, elements array<bigint>")


def sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """node, elements of the wanted nodes, from the text of one document of each, written."""
    ids = wanted.join(nodes.select("node", "first_id"), "node").select(F.col("first_id").alias("_v_id"), F.col("node").alias("_v_node"))
    some = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    some = some.join(ids.select("_v_id").distinct(), F.col("doc_id").eqNullSafe(F.col("_v_id")), "left_semi")
    sets = full_sets(some, words).join(ids.select("_v_node"), F.col("node") == F.col("_v_node"), "left_semi")
    return materialize(sets.dropDuplicates(["node"]), "minhash-sets")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Of the pairs (a, b) those whose full sets are similar enough."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets_of(wanted, docs, nodes, words, id_col, text_col)
    joined = (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("eb")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("elements").alias("ea")), "a")
        .withColumn("both", F.size(F.array_intersect("ea", "eb")))
    )
    union = F.size("ea") + F.size("eb") - F.col("both")
    return materialize(joined.where(F.col("both") * 100 >= union * percent).select("a", "b"), "minhash-links")


def fits(x: str, y: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def rare_pairs(placed: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """a, b: the pairs of nodes in different components that can be similar enough; ``placed`` are node, n, comp.

    Elements are ordered by the number of these nodes that hold them, rare ones first; private elements (of one node) come
    first and meet nothing. Where the first element that two sets share stands at places i and j, they share 1 + min(n_a - i,
    n_b - j) at most, and sets of similarity s share s / (1 + s) (n_a + n_b) at least. So the smaller set needs only its first
    n - 2 s / (1 + s) n + 1 elements, the larger one an element at place j only against sizes that leave enough after it:
    it goes to the classes of these sizes (steps of one percent). Sets meet on (element, class), and only there where
    different components do. A copy with too many words of its own meets nothing: what it shares comes too late."""
    nodes_ = placed.select("node", "n", "comp").distinct()
    elements = sets_of(nodes_.select("node"), docs, nodes, words, id_col, text_col).select("node", F.explode("elements").alias("element"))
    held = elements.groupBy("element").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
    shared = elements.join(held, "element").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("held", "element"))).alias("shared"))
    shared = shared.join(nodes_, "node").withColumn("c", F.size("shared"))
    n, least = F.col("n"), F.ceil(F.col("n") * percent / 100).cast("int")
    first = shared.where(F.col("c") >= least).withColumn("first", F.slice("shared", F.lit(1), F.greatest(F.col("c") - least + 1, F.lit(0))))
    first = first.select("node", "n", "c", "comp", F.posexplode("first.element").alias("at", "element")).withColumn("at", F.col("at") + n - F.col("c") + 1)
    first = materialize(first, "minhash-prefixes")

    def size_class(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) * 100).cast("int")

    small = first.where((n - F.col("at") + 1) * (100 + percent) >= n * 2 * percent).withColumn("class", size_class(n))
    most = F.least(F.floor((n - F.col("at") + 1) * (100 + percent) / percent).cast("bigint") - n, n)
    large = first.where(most >= least).withColumn("class", F.explode(F.sequence(size_class(least), size_class(most))))
    keys = [side.select("element", "class", "comp") for side in (small, large)]
    keys = keys[0].unionByName(keys[1]).groupBy("element", "class").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    keys = materialize(keys.where(F.col("lo") != F.col("hi")).select("element", "class"), "minhash-meeting")
    x, y = (
        side.join(keys, ["element", "class"], "left_semi").select("element", "class", *[F.col(c).alias(f"{c}_{z}") for c in ("node", "n", "c", "comp", "at")])
        for side, z in ((small, "a"), (large, "b"))
    )
    needed = (F.col("n_a") + F.col("n_b")) * percent
    enough = (F.least("c_a", "c_b") * (100 + percent) >= needed) & ((F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) + 1) * (100 + percent) >= needed)
    met = (x["element"] == y["element"]) & (x["class"] == y["class"]) & (F.col("comp_a") != F.col("comp_b")) & (F.col("n_a") <= F.col("n_b"))
    pairs = x.join(y, met & fits("n_a", "n_b", percent) & enough)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable over the links, for the nodes that have any.

    Each round every node takes the smallest label of its neighbours, then the label of its label, until none changes."""
    both = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components-links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "components")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("comp")), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(seen, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        hop = labels.select(F.col("node").alias("low"), F.col("comp").alias("lower"))
        step = step.join(hop, "low").select("node", F.col("comp").alias("old"), F.least("low", "lower").alias("comp"))
        step = materialize(step, "components")
        labels = step.select("node", "comp")
        if step.where(F.col("comp") != F.col("old")).isEmpty():
            return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept, text_hash, keep_hash (the text hash of the
    component's first row by id, nulls last, and text hash)."""
    bands = bands_for(percent, rows)
    rows_ = materialize(sketched(docs, words, bands * rows, rows, id_col, text_col), "minhash-sketches")
    nodes = rows_.where(F.col("node").isNotNull()).groupBy("node")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = materialize(nodes.agg(F.min("doc_id").alias("first_id"), F.min(order).alias("first_row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "minhash-nodes")
    buckets = nodes.select("node", "n", F.posexplode("bands").alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    buckets = materialize(buckets.join(shared, ["band", "value"]), "minhash-buckets")
    met = buckets.groupBy("node").agg(F.sum("m").alias("met"))
    hubs = buckets.join(met, "node").groupBy("band", "value").agg(F.max(F.struct("met", "node", "n")).alias("hub"))
    hubs = hubs.select("band", "value", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))

    star = buckets.join(hubs, ["band", "value"]).where((F.col("hub") != F.col("node")) & fits("n", "hub_n", percent))
    star = star.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    star = materialize(star, "minhash-pairs")
    links = verified(star, docs, nodes, words, percent, id_col, text_col)
    comps = components(links)

    # Buckets that still hold more than one component: pairs across them, but for those that are verified already.
    placed = buckets.select("band", "value", "node", "n").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = placed.groupBy("band", "value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
    split = split.where((F.col("lo") != F.col("hi")) & (F.col("m") > 2)).select("band", "value")
    placed = materialize(placed.join(split, ["band", "value"], "left_semi"), "minhash-open")
    rest = materialize(rare_pairs(placed, docs, nodes, words, percent, id_col, text_col).join(star, ["a", "b"], "left_anti"), "minhash-pairs")
    if not rest.isEmpty():
        more = verified(rest, docs, nodes, words, percent, id_col, text_col)
        if not more.isEmpty():
            comps = components(links.unionByName(more))

    named = nodes.select("node", "first_id", "first_row").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.min("first_row").getField("text_hash").alias("keep_hash"))
    named = named.join(lowest, "comp").select("node", "component_id", "keep_hash")
    linked = rows_.where(F.col("node").isNotNull()).drop("bands").join(named, "node").drop("node")
    alone = rows_.where(F.col("node").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash", F.col("text_hash").alias("keep_hash"))
    out = linked.select("doc_id", "n_shingles", "component_id", "text_hash", "keep_hash").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one of each group of near-duplicates (the first by id, nulls last, and text hash), with all their
    columns. Rows without words stay; rows that repeat id and text are one."""
    found = near_duplicates(docs, words, percent, id_col=id_col, text_col=text_col)
    p = unused(docs, "_m")
    gone = found.where(~F.col("kept") | (F.col("text_hash") != F.col("keep_hash")))
    gone = gone.select(F.col("doc_id").alias(f"{p}_n"), F.col("text_hash").alias(f"{p}_o")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.withColumns({f"{p}_id": F.col(f"`{id_col}`").cast("bigint"), f"{p}_hash": F.xxhash64(text)})
    here = F.col(f"{p}_id").eqNullSafe(F.col(f"{p}_n")) & (F.col(f"{p}_hash") == F.col(f"{p}_o"))
    return rows.join(gone, here, "left_anti").dropDuplicates([f"{p}_id", f"{p}_hash", text_col]).drop(f"{p}_id", f"{p}_hash")


@register("op3_minhash_dedup")
def op3_minhash_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("text_hash", "keep_hash")
