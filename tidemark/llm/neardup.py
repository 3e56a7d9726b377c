"""Near-duplicate documents by bottom-k sketches of one hash function.

Texts become sets of hashed 5-word shingles. Equal sets collapse to one class. Each class keeps its
``SKETCH`` least hash values; inverted lists of the retained values generate candidates, the sketch of
the union estimates their Jaccard similarity and filters them, and the full sets verify it.

Lists are never expanded into pairs. A class can only have a link if other classes hold most of its
retained values, so all others leave at once. In every list one class is central: the one with the most
values that are about as frequent as the list is long, so that a family's purest member stands for it.
Each class is compared with the likeliest of the central classes of its lists, which connects a family of
thousands of copies by one comparison a member. Then only classes go on that share most of their
values with classes of other components. They are listed by prefixes of their full sets, rarest shingles
first: two sets with the required similarity share a shingle among the first quarter of each, early
enough that what follows can still suffice, and rare shingles make short lists. Here too each class is first
compared with the most central one, now by exact counts; then all pairs of a list that are still in
different components are.

Probability of missing a pair at the threshold: its estimate, its bitmap or its share of common values
lies 4.5 deviations off with less than 1e-5.

Null and blank texts are empty: they have no shingles and are linked with nothing. Texts with fewer than
five words are one shingle; very long texts are hashed in pieces, so that memory follows their words.
Classes are sets, not ids: each of several texts under one doc_id has the component of its own set, and a
null doc_id links like any other; a component without any id has a null component_id. Equal rows have equal
results, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import map_arrow, materialize, own_exchange
from ._text import BASE, Powers, binary_column, blocks, distinct, lower_table, mix, prefix_hash, space_table, span_hash, words

SHINGLE, THRESHOLD = 5, 75  # words; percent
SKETCH, PROBES, LEAST_ESTIMATE = 64, 24, 0.5
#: Least values of a sketch whose lists are counted, and words of the bitmap that stands for a sketch.
WINDOW, WORDS = 40, 8
#: Bits of the filter of wanted rows for each of them, and the largest filter in bytes; beyond it rows are joined instead.
FILTER_BITS, FILTER_BYTES = 16, 16 << 20
BLOCK = 1 << 19
BIT_COLUMNS = tuple(f"b{i}" for i in range(WORDS))


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in lower case, and each text's first. Long texts are cut at white space, so that work arrays stay small."""
    space, parts, counts, row_of = space_table(), [0], [], []
    for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while hi - lo > BLOCK:
            cut = np.flatnonzero(space[data[lo + BLOCK : min(hi, lo + 2 * BLOCK)]])
            if not len(cut):  # no white space in a whole block: it belongs to one word
                far = np.flatnonzero(space[data[lo + BLOCK : hi]])
                if not len(far):
                    break
                cut = far
            lo += BLOCK + int(cut[0])
            parts.append(lo)
            row_of.append(row)
        parts.append(hi)
        row_of.append(row)
    cuts, out, lower = np.array(parts, np.int64), [], lower_table()
    for a, b in blocks(cuts, BLOCK):
        piece, local = lower[data[cuts[a] : cuts[b]]], cuts[a : b + 1] - cuts[a]
        starts, ends, first = words(piece, local)
        out.append(span_hash(prefix_hash(piece, powers), starts, ends, powers))
        counts.append(np.diff(first))
    n = np.bincount(np.array(row_of, np.int64), np.concatenate(counts) if counts else None, len(offsets) - 1).astype(np.int64)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(n)])


def shingles(data: np.ndarray, offsets: np.ndarray, powers: Powers, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashed shingles of each text, as unsigned 64-bit integers."""
    w, first = word_hashes(data, offsets, powers)
    out = []
    if len(w) >= size:
        rolled = np.zeros(len(w) - size + 1, np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(BASE) + w[k : len(w) - size + 1 + k]
        rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(distinct(rolled[a : b - size + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for x in w[a:b]:
                h = h * np.uint64(BASE) + x
            out.append(mix(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def each_text(batch, powers: Powers, size: int):
    data, offsets = binary_column(batch, "raw")
    with np.errstate(over="ignore"):
        for lo, hi in blocks(offsets, BLOCK):
            yield from shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], powers, size)


def set_key(found: list[np.ndarray]) -> list[pa.Array]:
    """n, s1 and s2: a size and 128 bits that stand for each set."""
    with np.errstate(over="ignore"):
        s1 = np.array([s.sum(dtype=np.uint64) for s in found], np.uint64)
        s2 = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(BASE))) if len(s) else 0 for s in found], np.uint64)
    return [pa.array([len(s) for s in found], pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text) and its bytes."""
    raw = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(raw).alias("key"), raw.alias("raw"))


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, key (of the text), n (set size), s1 and s2 (that stand for the set), ``sketch``, ascending, and its bitmap, of each row."""

    def sketch(batches):
        powers = Powers()
        for batch in batches:
            found = list(each_text(batch, powers, size))
            low, bits = [], np.zeros((WORDS, len(found)), np.int64)
            for i, s in enumerate(found):
                k = (s[:SKETCH] >> np.uint64(1)).astype(np.int64)
                low.append(k)
                np.bitwise_or.at(bits[:, i], k % WORDS, np.int64(1) << (k // WORDS % 64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *set_key(found), pa.array(low, pa.list_(pa.int64())), *map(pa.array, bits)], names=["doc_id", "key", "n", "s1", "s2", "sketch", *BIT_COLUMNS])

    return map_arrow(keyed(docs), sketch, "doc_id long, key long, n long, s1 long, s2 long, sketch array<long>, " + ", ".join(f"{b} long" for b in BIT_COLUMNS))


def full_sets(docs: DataFrame, wanted: DataFrame, size: int = SHINGLE) -> DataFrame:
    """n, s1, s2 and the whole set of the rows whose (doc_id, key) is in ``wanted`` (and of a few others).

    A bitmap that has ``FILTER_BITS`` bits a wanted row stands for them, so that no text is shuffled to find
    them; where it would be larger than ``FILTER_BYTES`` the rows are joined.
    """
    rows, count = keyed(docs), wanted.count()
    bits = 1 << max(15, (FILTER_BITS * count - 1).bit_length())
    if bits > 8 * FILTER_BYTES:
        ids = wanted.select(F.col("doc_id").alias("i"), F.col("key").alias("k"))
        picked = rows.join(ids, rows.doc_id.eqNullSafe(ids.i) & (F.coalesce(rows.key, F.lit(0)) == F.coalesce(ids.k, F.lit(0))), "left_semi").withColumn("slot", F.lit(None).cast("long"))
        shared = None
    else:
        slot = F.pmod(F.xxhash64("doc_id", "key", F.lit("slot")), F.lit(bits))
        width = 8 * 4096
        maps = wanted.select(slot.alias("s")).groupBy(F.floor(F.col("s") / width).alias("k")).agg(F.bitmap_construct_agg(F.col("s") % width).alias("m")).collect()
        held = np.zeros(bits // 8, np.uint8)
        for r in maps:  # at most bits / width rows
            held[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["m"], np.uint8)
        shared = docs.sparkSession.sparkContext.broadcast(held)
        picked = rows.withColumn("slot", slot)

    def sets(batches):
        powers, held = Powers(), shared.value if shared else None
        for batch in batches:
            if held is not None:
                at = batch.column(1).to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            found = list(each_text(batch, powers, size))
            yield pa.RecordBatch.from_arrays([*set_key(found), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["n", "s1", "s2", "full"])

    return map_arrow(picked.select("raw", "slot"), sets, "n long, s1 long, s2 long, full array<long>")


def estimate(a: str, b: str) -> str:
    """Share of the union's ``SKETCH`` least values that both sketches hold."""
    union = f"slice(sort_array(array_union({a}, {b})), 1, {SKETCH})"
    return f"size(array_intersect(array_intersect({a}, {b}), {union})) / double(size({union}))"


def components(links: DataFrame, tag: str = "components") -> DataFrame | None:
    """(id, component) of every end of ``links`` (a, b): the least id that can be reached; None without links. Each round, a
    written table, takes the least label of the neighbours, then that label's own label, until none changes."""
    ends = materialize(links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("to")), F.struct(F.col("b").alias("id"), F.col("a").alias("to")))).alias("e")).select("e.*").distinct(), tag, few=True)
    labels = ends.groupBy("id").agg(F.least("id", F.min("to")).alias("component"))
    if ends.isEmpty():
        return None
    while True:
        near = ends.join(labels.select(F.col("id").alias("to"), F.col("component").alias("c")), "to").groupBy("id").agg(F.min("c").alias("c"))
        sunk = labels.join(near, "id").select("id", F.least("component", "c").alias("c"), F.col("component").alias("old"))
        jump = labels.select(F.col("id").alias("c"), F.col("component").alias("further"))
        new = materialize(sunk.join(jump, "c", "left").select("id", F.least("c", "further").alias("component"), "old"), tag, few=True)
        labels = new.select("id", "component")
        if new.where("component <> old").isEmpty():
            return labels


def bits_in_common(a: str, b: str) -> str:
    return " + ".join(f"bit_count({a}.{x} & {b}.{x})" for x in BIT_COLUMNS)


def least_bits(threshold: int) -> Column:
    """Bits in common that sketches of sets at the threshold have (sizes in ca.n, cb.n), less 4.5 deviations and collisions."""
    n, m = F.greatest("ca.n", "cb.n"), F.col("ca.n") + F.col("cb.n")
    k = F.least(F.lit(SKETCH), n)
    return k * (threshold / (100 + threshold)) * m / n - k * F.when(n > SKETCH, 0.3).otherwise(0.1)


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of the candidate ``pairs`` (a, b) those whose sketches estimate at least ``LEAST_ESTIMATE`` and whose full sets are linked."""
    sketch = lambda c: F.transform(F.slice(c, 1, SKETCH), lambda x: F.shiftrightunsigned(x, 1))
    side = lambda k: sets.select(F.col("cid").alias(k), sketch(F.col("full")).alias(f"s{k}"), F.col("full").alias(f"f{k}"))
    x = pairs.join(side("a"), "a").join(side("b"), "b").where(F.expr(estimate("sa", "sb")) >= LEAST_ESTIMATE)
    x = x.select("a", "b", F.size(F.array_intersect("fa", "fb")).cast("long").alias("both"), F.size("fa").alias("na"), F.size("fb").alias("nb"))
    return materialize(x.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * threshold).select("a", "b"), "links", few=True)


def classes_of(sk: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: cid, its key, sketch and bitmap, the least doc_id that has it and one row (doc_id, key) that holds it."""
    first = lambda c: F.any_value(c).alias(c)
    found = sk.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "key")).alias("at"), first("sketch"), *map(first, BIT_COLUMNS))
    return materialize(found.withColumn("cid", F.monotonically_increasing_id()), "classes")


def shared_values(classes: DataFrame, of: str) -> DataFrame:
    """(v, m): retained values that several classes hold, and how many; ``of`` counts those of several components."""
    values = classes.select(F.explode(F.slice("sketch", 1, WINDOW)).alias("v"), of)
    if of == "cid":
        return values.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return values.groupBy("v").agg(F.min(of).alias("lo"), F.max(of).alias("hi")).where("lo <> hi").select("v")


def enough(threshold: int) -> Column:
    """Retained values that a set with a link shares with others at least: the threshold's part, less 4.5 deviations
    where it or its partner may exceed the window."""
    share = threshold / 100
    loose = 4.5 * (WINDOW * share * (1 - share)) ** 0.5
    return F.least(F.col("n"), F.lit(WINDOW)) * share - F.when(F.col("n") * 100 >= (WINDOW + 1) * threshold, loose).otherwise(0)


def central_links(near: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) of each class with the likeliest of the central classes of its lists."""
    lists = near.select("cid", F.explode("probes").alias("p")).select("cid", F.col("p.v").alias("v"), F.col("p.like").alias("like"))
    best = lists.groupBy("v").agg(F.max(F.struct("like", (-F.col("cid")).alias("order"))).alias("x"), F.count(F.lit(1)).alias("m")).where("m > 1")
    best = best.select(own_exchange("v"), (-F.col("x.order")).alias("b"))
    pairs = lists.select("v", F.col("cid").alias("a")).join(best, "v").where("a <> b").select("a", "b").distinct()
    info = near.select("cid", "n", *BIT_COLUMNS)
    ask = (F.col("ca.n") * 100 >= F.col("cb.n") * threshold) & (F.col("cb.n") * 100 >= F.col("ca.n") * threshold)
    pairs = pairs.join(info.alias("ca"), F.col("a") == F.col("ca.cid")).join(info.alias("cb"), F.col("b") == F.col("cb.cid")).where(ask).withColumn("bits", F.expr(bits_in_common("ca", "cb"))).where(F.col("bits") >= least_bits(threshold))
    return verified(best_of(pairs, "a", "b", "bits"), sets, threshold)


def prefixes(rest: DataFrame, threshold: int) -> DataFrame:
    """Rows (x, cid, n, c, left, score) of ``rest`` (cid, n, c, full): the rare shingles of which a link must share one, how many
    follow them in the set, and how central the set is among those with shingles about as frequent."""
    each = rest.select("cid", "n", "c", F.explode("full").alias("x"))
    ranks = each.groupBy("x").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select(own_exchange("x"), "df")
    shared = each.join(ranks, "x").groupBy("cid", "n", "c").agg(F.collect_list("x").alias("xs"), F.collect_list("df").alias("dfs"))

    def cut(batches):
        for batch in batches:
            xs, dfs = batch.column(3), batch.column(4)
            at, x, df = xs.offsets.to_numpy(), xs.values.to_numpy(), dfs.values.to_numpy()
            rows, out = [], {k: [] for k in ("x", "left", "score")}
            for i, n in enumerate(batch.column(1).to_pylist()):
                held = slice(at[i], at[i + 1])
                order = np.lexsort((x[held], df[held]))
                # in rank, the shingles that no other class has come first; a link shares one of the first n - ceil(share * n) + 1
                take = max(0, n - -(-n * threshold // 100) + 1 - (n - len(order)))
                d = df[held][order]
                like = np.searchsorted(d, 2 * d[:take], "right") - np.searchsorted(d, (d[:take] + 1) // 2)
                rows.append(np.full(len(like), i))
                out["x"].append(x[held][order[:take]])
                out["left"].append(len(order) - np.arange(len(like)))
                out["score"].append(like.astype(float) ** 2 / n)
            take = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            cols = [pa.array(np.concatenate(v) if v else [], t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([cols[0], *(batch.column(k).take(take) for k in range(3)), *cols[1:]], names=["x", "cid", "n", "c", "left", "score"])

    return materialize(map_arrow(shared, cut, "x long, cid long, n long, c long, left long, score double"), "prefixes")


def prefix_pairs(heads: DataFrame, threshold: int) -> DataFrame:
    """(a, b): pairs of classes of different components that share a rare shingle early enough in both sets."""
    mixed = heads.groupBy("x").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select(own_exchange("x"))
    heads = materialize(heads.join(mixed, "x", "left_semi").select("x", "cid", "n", "c", "left"), "heads")
    other = heads.select("x", *[F.col(k).alias(f"{k}_") for k in ("cid", "n", "c", "left")])
    # from the first shared shingle on, as many are left on either side as the overlap needs
    need = F.ceil((F.col("n") + F.col("n_")) * threshold / (100 + threshold) - 1e-9)
    ask = (F.col("c") < F.col("c_")) & (F.col("left") >= need) & (F.col("left_") >= need)
    return heads.join(other, (heads.x == other.x) & ask).select(F.col("cid").alias("a"), F.col("cid_").alias("b")).distinct()


def best_of(pairs: DataFrame, key: str, other: str, by: str) -> DataFrame:
    """Of each key the partner that is best by a measure."""
    return pairs.groupBy(key).agg(F.max(F.struct(by, other)).alias("x")).select(key, F.col(f"x.{other}").alias(other))


def class_components(classes: DataFrame, docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(id, component) of every class that has a link."""
    lists = shared_values(classes, "cid").select(own_exchange("v"), "m")
    values = classes.select("cid", F.posexplode(F.slice("sketch", 1, WINDOW)).alias("p", "v"))
    near = values.join(lists, "v").groupBy("cid").agg(F.collect_list(F.struct("p", "v", "m")).alias("vs"))
    # a value's centrality in a class: how many of the class's values are about as frequent
    probes = "transform(filter(vs, s -> s.p < {}), s -> struct(s.v as v, size(filter(vs, o -> o.m <= 2 * s.m and s.m <= 2 * o.m)) as like))".format(PROBES)
    near = near.join(classes.select("cid", "n", "s1", "s2", "at", "sketch", *BIT_COLUMNS), "cid").where(F.size("vs") >= enough(threshold))
    near = materialize(near.withColumn("probes", F.expr(probes)).drop("vs"), "near")
    found = full_sets(docs, near.select("at.*"), size).dropDuplicates(["n", "s1", "s2"])
    sets = materialize(found.join(near.select("cid", "n", "s1", "s2"), ["n", "s1", "s2"]).select("cid", "n", "full"), "sets")
    comps = components(central_links(near, sets, threshold))
    if comps is None:
        comps = near.sparkSession.createDataFrame([], "id long, component long")

    # what is left: classes that share enough values with classes of other components
    now = materialize(near.select("cid", "n", "sketch").join(comps.withColumnRenamed("id", "cid"), "cid", "left").withColumn("c", F.coalesce("component", "cid")), "now")
    mixed = shared_values(now, "c").select(own_exchange("v"))
    values = now.select("cid", F.explode(F.slice("sketch", 1, WINDOW)).alias("v"))
    counts = values.join(mixed, "v").groupBy("cid").agg(F.count(F.lit(1)).alias("common"))
    rest = now.join(counts, "cid").where(F.col("common") >= enough(threshold)).select("cid", "c", "n")
    heads = prefixes(materialize(rest.join(sets.select("cid", "full"), "cid"), "rest"), threshold)
    # each class with the most central one of the lists of its rare shingles, then all pairs between components that those have not connected
    top = heads.groupBy("x").agg(F.max(F.struct("score", (-F.col("cid")).alias("order"), "c")).alias("t"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    top = top.select(own_exchange("x"), (-F.col("t.order")).alias("b"), F.col("t.c").alias("d"))
    best = best_of(heads.select("x", F.col("cid").alias("a"), "c").join(top, "x").where("c <> d").groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")), "a", "b", "k")
    comps = merged(comps, verified(best, sets, threshold))
    now = heads.drop("c").join(comps.select(F.col("id").alias("cid"), F.col("component").alias("c")), "cid", "left").withColumn("c", F.coalesce("c", "cid"))
    return merged(comps, verified(prefix_pairs(now, threshold), sets, threshold))


def across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) with their components ca and cb, where those differ."""
    side = lambda k: comps.select(F.col("id").alias(k), F.col("component").alias(f"c{k}"))
    x = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return x.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).where("ca <> cb")


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components once ``links`` are added: only the components that they touch are looked at again."""
    over = components(across(links, comps).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    if over is None:
        return comps
    over = over.select(F.col("id").alias("component"), F.col("component").alias("new"))
    old = comps.join(over, "component", "left").select("id", F.coalesce("new", "component").alias("component"))
    single = over.select(F.col("component").alias("id"), F.col("new").alias("component")).join(comps, "id", "left_anti")
    return materialize(old.unionByName(single), "components", few=True)


def grouped(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """doc_id, key (of the text), n, component_id and ``part`` of every row: a number of its component, null for empty texts."""
    sk = materialize(sketches(docs, size), "sketches")
    classes = classes_of(sk)
    comps = class_components(classes, docs, threshold, size)
    own = classes.select("n", "s1", "s2", "cid", "rep").join(comps, F.col("cid") == F.col("id"), "left").withColumn("part", F.coalesce("component", "cid")).drop("id", "component")
    least = own.groupBy("part").agg(F.min("rep").alias("component_id")).select(own_exchange("part"), "component_id")
    own = own.join(least, "part").select("n", "s1", "s2", "part", "component_id")
    x = sk.select("doc_id", "key", "n", "s1", "s2").join(own, ["n", "s1", "s2"], "left")
    return x.select("doc_id", "key", "n", F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "part")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    x = grouped(docs, threshold, size).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return x.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component, that with the least doc_id (a null id only where no other is); empty texts stay.

    Only keys are grouped. Rows that occur several times are made single apart, so that no other text is grouped.
    """
    rows = materialize(grouped(docs, threshold, size), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    one = rows.where("part is not null").groupBy("part").agg(F.min(place).alias("x")).select("x.doc_id", "x.key")
    empty = rows.where("part is null").select("doc_id", "key").distinct()
    times = rows.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("times"))
    a, b = one.union(empty).distinct().alias("a"), times.alias("b")
    same = lambda x, y: F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id")) & F.col(f"{x}.key").eqNullSafe(F.col(f"{y}.key"))
    keep = materialize(a.join(b, same("a", "b")).select("a.doc_id", "a.key", "b.times"), "keep").alias("k")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("binary")).alias("key"), doc.alias("doc")).alias("d")
    got = whole.join(keep, same("d", "k")).select("d.doc_id", "d.key", "d.doc", "k.times")
    many = got.where("times > 1").groupBy("doc_id", "key").agg(F.min_by("doc", F.to_json("doc")).alias("doc")).select("doc")  # the same one in every run
    return got.where("times = 1").select("doc").union(many).select("doc.*")
