"""N-gram Jaccard join: size-aware heavy-light join on distinct word shingles.

Exact for the threshold. Three lossless cuts precede the join, each in one shuffle:

1. Documents with equal shingle sets form one class; only its smallest id goes on.
2. A set of n with a link lacks at most ``n - ceil(t n)`` shingles in its partner, so of its q shingles whose hash
   is divisible by ``SHARE`` at least ``q - n + ceil(t n)`` occur in another set; sets with fewer leave. Each batch
   of documents sends a shingle at most once, so a shingle that a third of all documents hold sends one row per batch.
3. Among the rest, document frequencies order every set from its rarest shingle; sets with too few shared
   shingles leave.

The join is size-aware. Small ("light") sets enumerate the fixed-size subsets (pairs) of their rarest
shingles; two light sets that link share such a pair. Large ("heavy") sets scan inverted lists of single
shingles. An entry carries the overlap that is still possible when its key is the first one that two sets share, so
pairs, and entries against the smallest set of their list, leave when that is below what the threshold asks. The boundary is the size with the smallest total cost, from grouped sums per size. A list of any length is worked off by
pivots: all members are verified against the list's pivots, members that turn out connected to a pivot need no
further comparison with its class, and the number of pivots grows fourfold per round until every list is done. No
list is cut and no pair is skipped unless its two ends are already known to be connected. The links found are thus a part
that spans every component; ``classes(full=True)`` and ``link_counts`` verify all pairs of all lists instead.

Edge cases: null, empty and blank texts have no shingle and link with nothing; fewer than ``width`` words make
one shingle of the whole sequence; repeated documents share a class; extra columns are ignored; an empty table
gives an empty result; null ids form no pair rows and keep a null component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentsift.llm.common import ANY_ID, ascii_lower, bloom_joins, components, cut, drop_cut, release, tidy, word_hashes

WIDTH = 5
PERCENT = 75
SHARE = 3
PAIR_BLOCK = 512  # members of a list on each side of a join piece when all pairs are asked for
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of Fibonacci hashing


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MULT
    x = x ^ (x >> np.uint64(29))
    x = x * _MULT
    return x ^ (x >> np.uint64(32))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each list of word hashes."""
    offsets, flat = _flat(column)
    n = len(flat)
    rolled = _mix(flat + np.uint64(1))
    grams = rolled.copy()
    for k in range(1, width):
        grams = _mix(grams[: n - k] + rolled[k:]) if k < n else grams[:0]
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= width:
            s = np.unique(grams[a: b - width + 1])
        elif b > a:
            s = rolled[a: a + 1]
            for k in range(a + 1, b):
                s = _mix(s + rolled[k: k + 1])
            s = _mix(s ^ np.uint64(b - a))
        else:
            s = flat[:0]
        out.append(s)
    return out


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))


def _signatures(width: int):
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            with np.errstate(over="ignore"):
                s1 = [np.add.reduce(_mix(s), dtype=np.uint64) for s in sets]
                s2 = [np.bitwise_xor.reduce(_mix(s + _MULT)) if len(s) else np.uint64(0) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array(s1, np.uint64).view(np.int64)), pa.array(np.array(s2, np.uint64).view(np.int64)),
                _lists([s[s % np.uint64(SHARE) == 0] for s in sets])],
                names=["doc_id", "n", "s1", "s2", "part"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)],
                names=["doc_id", "n", "sh"])
    return run


_SINGLE, _COUNTED, _SUM = 0, 1, 2


def _once_per_batch(batches):
    """(token, doc_id, kind, met): each token at most once per batch.

    A token of several documents of the batch is counted for them here (``_SUM`` rows, one per document) and sent
    once as ``_COUNTED``; a token of one document is sent as ``_SINGLE``.
    """
    for batch in batches:
        offsets, flat = _flat(batch.column(1))
        docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(offsets))
        order = np.argsort(flat, kind="stable")
        t, d = flat[order], docs[order]
        first = np.ones(len(t), bool)
        first[1:] = t[1:] != t[:-1]
        twice = ~first
        twice[:-1] |= ~first[1:]
        met, times = np.unique(d[twice], return_counts=True)
        kind = np.where(twice[first], _COUNTED, _SINGLE)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([t[first], _mix(met.astype(np.uint64))]).view(np.int64)),
            pa.array(np.concatenate([d[first], met]).astype(np.int64)),
            pa.array(np.concatenate([kind, np.full(len(met), _SUM)]).astype(np.int8)),
            pa.array(np.concatenate([np.zeros(len(kind)), times]).astype(np.int32))],
            names=["token", "doc_id", "kind", "met"])


def _neighbours(batches):
    """(doc_id, met) from a partition sorted by token: tokens that another batch sent too; holds one batch and one row.

    A row is counted when the row before or after it has its token, so the last row of a batch waits for the next.
    """
    def counted(t, d, kind, before, after):
        same = t[1:] == t[:-1]
        hit = np.zeros(len(t), bool)
        hit[1:] |= same
        hit[:-1] |= same
        if len(t):
            hit[0] |= t[0] == before if before is not None else False
            hit[-1] |= t[-1] == after if after is not None else False
        ids, times = np.unique(d[hit & (kind == _SINGLE)], return_counts=True)
        return ids, times

    held, before = None, None
    for batch in batches:
        t, d, kind, met = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        own = kind == _SUM
        ids, times = [d[own]], [met[own]]
        t, d, kind = t[~own], d[~own], kind[~own]
        if len(t):
            if held is not None:
                t, d, kind = (np.concatenate([x, y]) for x, y in zip(held, (t, d, kind), strict=True))
            i, n = counted(t[:-1], d[:-1], kind[:-1], before, t[-1])
            ids.append(i)
            times.append(n)
            if len(t) > 1:
                before = t[-2]
            held = (t[-1:], d[-1:], kind[-1:])
        yield _pairs(ids, times)
    if held is not None:
        i, n = counted(*held, before, None)
        yield _pairs([i], [n])


def _pairs(ids, times):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids).astype(np.int64)),
                                       pa.array(np.concatenate(times).astype(np.int64))], names=["doc_id", "met"])


def _overlaps(percent: int):
    def run(batches):
        for batch in batches:
            oa, fa = _flat(batch.column(2))
            ob, fb = _flat(batch.column(3))
            keep = []
            for i in range(batch.num_rows):
                a, b = fa[oa[i]: oa[i + 1]], fb[ob[i]: ob[i + 1]]
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                same = int((a[at] == b).sum()) if len(a) else 0
                keep.append(100 * same >= percent * (len(a) + len(b) - same))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)],
                                             names=["a", "b"])
    return run


#: Pairs of the rarest shared shingles of a set, as (key, last shingle, shingles from the pair's first on but those before it).
SUBSETS = ("flatten(transform(pre, (x, i) -> transform(slice(pre, i + 2, size(pre)), (y, k) -> "
           "struct(xxhash64(x.t, y.t) as key, y as last, s - i - k as rem))))")


def boundary(ranked: DataFrame) -> int:
    """Largest light size: least total of the entries read for subsets of sets up to it and for single shingles above it.

    Pivots grow fourfold per round, so a list of L entries is open, and each entry read, for up to 1 + log4(L) rounds. L is
    the shingle's document frequency; the list of two rare shingles is taken as done in its first round.
    """
    rounds = "aggregate(slice(pre, 1, greatest(size(pre) - 1, 0)), 0d, (a, t) -> a + 1 + log2(t.df) / 2)"
    cost = ranked.groupBy("n").agg(F.sum(F.expr(rounds)).alias("scanned"),
                                   F.sum(F.expr("size(pre) * (size(pre) - 1) / 2")).alias("subsets"))
    # One row per distinct size; the running total needs its order only.
    best = (cost.withColumn("total", F.sum(F.col("scanned") - F.col("subsets")).over(Window.orderBy("n")))
            .orderBy(F.desc("total"), "n").limit(1).filter("total > 0").select("n").collect())
    return int(best[0][0]) if best else 0


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
            percent: int = PERCENT, full: bool = False) -> tuple[DataFrame, DataFrame]:
    """(membership, links): membership (doc_id, n, rep) of equal-set classes, links (a, b) between representatives.

    The links are all there are with ``full``; otherwise a subset of them that spans every component.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    hashed = base.select("doc_id", word_hashes(ascii_lower(F.col("text"))).alias("wh")).filter("doc_id is not null")
    sig = cut(hashed.mapInArrow(tidy(_signatures(width)), "doc_id long, n long, s1 long, s2 long, part array<long>"),
              "op2sig")
    reps = sig.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"))
    member = cut(sig.select("doc_id", "n", "s1", "s2", F.size("part").alias("q")).join(reps, ["s1", "s2", "n"], "left")
                 .select("doc_id", "n", "q", F.coalesce("rep", "doc_id").alias("rep")), "op2cls")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = sig.filter("n > 0").select("doc_id", "part").mapInArrow(
        _once_per_batch, "token long, doc_id long, kind byte, met int")
    met = (tokens.repartition(parts, "token").sortWithinPartitions("token")
           .mapInArrow(_neighbours, "doc_id long, met long").groupBy("doc_id").agg(F.sum("met").alias("met")))
    alive = cut(member.filter("doc_id = rep and n > 0").join(met, "doc_id", "left")
                .filter(f"coalesce(met, 0) >= q - n + ceil({percent} * n / 100)").select("doc_id"), "op2alive")
    drop_cut(sig)
    release(spark)
    with bloom_joins(spark):  # whole texts of documents that left are not shuffled
        sets = cut(base.join(alive.filter(ANY_ID), "doc_id", "left_semi")
                   .select("doc_id", word_hashes(ascii_lower(F.col("text"))).alias("wh"))
                   .mapInArrow(tidy(_sets(width)), "doc_id long, n long, sh array<long>"), "op2sets")
    release(spark)
    links = _join(sets, percent, full)
    return member, links


def _rank(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, s, pre): the number of shared shingles, and the shared part of each set's rarest ``n - ceil(t n) + 1`` shingles, rarest first.

    One more shingle than single-token lists need is kept as the last element for the subset enumeration.
    """
    rows = sets.select("doc_id", "n", F.explode("sh").alias("t"))
    df = rows.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1")
    shared = rows.join(df, "t").groupBy("doc_id", "n").agg(F.collect_list(F.struct("df", "t")).alias("ts"))
    shared = shared.withColumn("least", F.expr(f"cast(ceil({percent} * n / 100) as int)")).filter("size(ts) >= least")
    take = "cast(n - least + 2 - (n - size(ts)) as int)"
    return shared.select("doc_id", "n", F.size("ts").alias("s"), F.expr(f"slice(array_sort(ts), 1, greatest({take}, 0))").alias("pre"))


def _distinct_lists(entries: DataFrame, percent: int) -> DataFrame:
    """(key, doc_id, n, rem): lists of two or more members that hold a heavy one; of lists with equal members one is kept.

    An entry whose ``rem`` is too small for the smallest set of its list leaves first. Copies share most of their
    shingles, so most lists of a group have the same members; two 64-bit digests of the members tell lists apart. The
    one kept has the rarest last shingle: it comes first in every member, so every ``rem`` is the largest there.
    """
    floor = (entries.groupBy("key").agg(F.min("n").alias("lo"), F.max("heavy").alias("h"), F.count("*").alias("c"))
             .filter("h and c > 1").select("key", "lo"))
    able = entries.join(floor, "key").filter(_reaches("rem", "lo", percent))
    stats = (able.groupBy("key", "last").agg(F.max("heavy").alias("h"), F.count("*").alias("c"),
                                             F.bit_xor(F.xxhash64("doc_id")).alias("x"),
                                             F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y"))
             .filter("h and c > 1").groupBy("c", "x", "y").agg(F.min(F.struct("last", "key")).alias("k"))
             .select("k.key"))
    return able.join(stats, "key", "left_semi").select("key", "doc_id", "n", "rem")


def _reaches(rem: str, other: str, percent: int) -> str:
    """Whether an overlap of ``rem`` is enough for sets of ``n`` and ``other`` shingles."""
    return f"{100 + percent} * {rem} >= {percent} * (n + {other})"


def _all_pairs(keys: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of members of a list; a long list is joined in pieces of two blocks of members."""
    sizes = keys.groupBy("key").agg(F.ceil(F.count("*") / PAIR_BLOCK).cast("int").alias("blocks"))
    dealt = keys.select("key", "doc_id", "n", "rem").join(sizes, "key").withColumn(
        "own", F.expr("cast(pmod(xxhash64(doc_id, 7), blocks) as int)"))
    left = dealt.select("key", F.col("own").alias("b1"), F.explode(F.expr("sequence(own, blocks - 1)")).alias("b2"),
                        "doc_id", "n", "rem")
    right = dealt.select("key", F.explode(F.expr("sequence(0, own)")).alias("b1"), F.col("own").alias("b2"),
                         F.col("doc_id").alias("d"), F.col("n").alias("dn"), F.col("rem").alias("drem"))
    return (left.join(right, ["key", "b1", "b2"]).filter("b1 < b2 or doc_id < d")
            .filter(_reaches("least(rem, drem)", "dn", percent))
            .select(F.least("doc_id", "d").alias("a"), F.greatest("doc_id", "d").alias("b")).distinct())


def _verify(pool: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    here = pool.join(ids, "doc_id", "left_semi")  # few in late rounds: then the pool stays where it is
    sa = here.select(F.col("doc_id").alias("a"), F.col("sh").alias("sa"))
    sb = here.select(F.col("doc_id").alias("b"), F.col("sh").alias("sb"))
    return cut(pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
               .mapInArrow(tidy(_overlaps(percent)), "a long, b long"), "op2links")


def _join(sets: DataFrame, percent: int, full: bool = False) -> DataFrame:
    spark = sets.sparkSession
    ranked = cut(_rank(sets, percent), "op2rank")
    release(spark)
    small = boundary(ranked)
    # The list entry of single tokens leaves out the extra element; light sets pair up all their elements.
    # rem: shingles from the key on, the most that two sets can share if the key holds their first common ones.
    single = (ranked.select("doc_id", "n", "s", F.posexplode(F.expr("slice(pre, 1, size(pre) - 1)")).alias("i", "last"))
              .select(F.col("last.t").alias("key"), "last", "doc_id", "n", F.expr(f"n > {small}").alias("heavy"),
                      F.expr("s - i").alias("rem")))
    subsets = (ranked.filter(f"n <= {small}").select("doc_id", "n", F.explode(F.expr(SUBSETS)).alias("e"))
        .select("e.key", "e.last", "doc_id", "n", F.lit(True).alias("heavy"), "e.rem"))
    lists = _distinct_lists(single, percent)
    keys = cut(lists.unionByName(_distinct_lists(subsets, percent)).withColumn("cls", F.col("doc_id")), "op2keys")
    release(spark)
    # Only sets in some list are compared; the rest need not be moved again.
    with bloom_joins(spark):
        pool = cut(sets.join(keys.select("doc_id").filter(ANY_ID), "doc_id", "left_semi").select("doc_id", "sh"),
                   "op2pool")
    drop_cut(sets)
    release(spark)
    if full:
        pairs = cut(_all_pairs(keys, percent), "op2pairs")
        links = _verify(pool, pairs, percent)
        for spent in (keys, pool, ranked, pairs):
            drop_cut(spent)
        return links
    links, turn = None, 0
    while keys.limit(1).count():
        # One pivot per slot of a list. Slots hash classes and documents by turns: unlike classes get a pivot
        # each, and large classes that must be compared with each other get many. A fixed order lets lists share pivots.
        slot = F.pmod(F.xxhash64("cls" if turn % 2 else "doc_id"), F.lit(4 ** turn))
        top = (keys.groupBy("key", slot.alias("slot"))
               .agg(F.min(F.struct(F.xxhash64("doc_id").alias("o"), F.col("doc_id").alias("d"), F.col("n"),
                                   F.col("rem"), F.col("cls").alias("c"))).alias("p"))
               .groupBy("key").agg(F.collect_list("p").alias("ps")))
        met = keys.join(top.select("key", F.explode("ps").alias("p")), "key")
        pairs = cut(met.filter("doc_id <> p.d and cls <> p.c")
                    .filter(_reaches("least(rem, p.rem)", "p.n", percent))
                    .select(F.least("doc_id", "p.d").alias("a"), F.greatest("doc_id", "p.d").alias("b")).distinct(),
                    "op2pairs")
        found = _verify(pool, pairs, percent)
        links = found if links is None else links.unionByName(found)
        # Classes spread one link per round: equal classes are connected for certain, which is all that is used.
        ends = found.select("a", "b").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        known = keys.select(F.col("doc_id").alias("b"), "cls").distinct()
        cls = (ends.join(known, "b").groupBy(F.col("a").alias("doc_id")).agg(F.min("cls").alias("now")))
        rest = (keys.join(top, "key").filter(~F.exists("ps", lambda p: p["d"] == F.col("doc_id")))
                .join(cls, "doc_id", "left")
                .select("key", "doc_id", "n", "rem", F.least("cls", F.coalesce("now", "cls")).alias("cls")))
        # A list goes on while members outside one class remain; its pivots have met all members.
        open_ = (rest.groupBy("key").agg(F.min("cls").alias("first"), F.max("cls").alias("final"),
                                         F.min("n").alias("lo"), F.max("rem").alias("most"))
                 .filter("first <> final").select("key", "lo", "most"))
        new = cut(rest.join(open_, "key").filter(_reaches("least(rem, most)", "lo", percent))
                  .select("key", "doc_id", "n", "rem", "cls"), "op2keys")
        drop_cut(keys)
        drop_cut(pairs)
        keys, turn = new, turn + 1
        release(spark)
    for spent in (keys, pool, ranked):
        drop_cut(spent)
    return links if links is not None else spark.createDataFrame([], "a long, b long")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               percent: int = PERCENT) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id)."""
    member, links = classes(docs, id_col, text_col, width, percent)
    comp = components(links, "op2end").select(F.col("node").alias("rep"), "component")
    out = (member.join(comp, "rep", "left")
           .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")))
    nulls = docs.filter(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nulls)


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                percent: int = PERCENT) -> DataFrame:
    """One row per document with an id: (doc_id, n_shingles, n_links), the number of documents it links with."""
    member, links = classes(docs, id_col, text_col, width, percent, full=True)
    size = member.filter("n > 0").groupBy("rep").agg(F.count("*").alias("size"))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = (both.join(size.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep"))
            .agg(F.sum("size").alias("near")))
    count = F.when(F.col("n") > 0, F.col("size") - 1 + F.coalesce("near", F.lit(0))).otherwise(F.lit(0))
    return (member.join(size, "rep", "left").join(near, "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), count.cast("long").alias("n_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the near copies: the smallest id of each component stays (rows with a null id stay).

    Of rows that repeat both id and text one stays; rows of one id with different texts are different documents of one
    component, and all stay if their id does.
    """
    found = ngram_join(docs, id_col, text_col).filter("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.max(F.col("doc_id") != F.col("component_id")).alias("gone"))
    marks = cut(found.filter("gone or rows > 1").select(F.col("doc_id").alias(id_col), "gone"), "op2marks")
    kept = docs.join(marks.select(id_col), id_col, "left_anti")
    repeated = marks.filter("not gone")
    if repeated.limit(1).count() == 0:
        return kept
    again = docs.join(repeated.select(id_col), id_col, "left_semi").dropDuplicates([id_col, text_col])
    return kept.unionByName(again)
