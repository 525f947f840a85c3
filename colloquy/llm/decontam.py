"""Benchmark decontamination by SimHash windows, in DataFrame operations only.

For every benchmark item, the windows of a document that have as many words as
the item get a 64-bit SimHash of their words.  Multi-index Hamming blocks find
the items near a window: the bits are cut into RADIUS + 1 blocks, and two
fingerprints within RADIUS agree in at least one block, so a join on (size,
block number, block bits) loses none.  Candidates within the radius are then
verified by the exact weighted similarity of their 5-word shingles, and count
as leaks from LEAST on.

Windows.  Of all item-sized windows, at any offset against the item, those are
fingerprinted that can reach LEAST by an exact upper bound of the similarity
(``_runs``), taken from the shingles that document and item share; the shingle
join against the (small) benchmark finds these without moving any text.

Long items.  Neighbouring windows share all but one word, so nothing is worked
out per window and word: a shared shingle enters the sums at the first window
that holds it and leaves them after the last, and running sums over these
events give every window's bound and similarity; a fingerprint's counters are
those of the window before, less the word that left, plus the one that came.

Similarity: sum of w * min over sum of w * max of the shingle counts; w is 1 for
a shingle that the item lacks, else falls with the number of items that have it
(1 / items, scaled so that an item's shingles weigh 1 on average), so that
boilerplate common to many items counts less than an item's own words.  Weights
are whole multiples of 1 / UNIT, so sums are the same in any order.

Words are runs without ASCII white space, A-Z lower-cased.  Items under five
words have no shingle and match nothing; null texts have no words; a window
longer than its document is the whole document.  An item is an id (null
included) with its words: repeated rows of a benchmark count once, different
words under one id are items of their own.  Results are one row per document and
item; repeated rows of a document count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import checkpoint, fresh

WIDTH = 5
RADIUS = 20
LEAST = 0.75
UNIT = 1 << 32    # weights are counted in this part of one
RUN = 1024        # most windows whose fingerprints follow from one another
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    low = F.btrim(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_SPACE))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(
        F.split(low, r"[\x20\x09-\x0D]+", -1))


def shingles_of(words: Column) -> Column:
    """Hash of every run of WIDTH words, in order.  ``words`` must be a plain
    column: an expression would be worked out again for every run."""
    n = F.size(words) - WIDTH + 1
    one = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WIDTH)))
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<bigint>"))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


_LANES = f"{(1 << 32) | 1}L"   # the two bits of a word hash that one long adds up


def _print(lanes: str, size: str) -> str:
    """SQL of the fingerprint from its counters; bit b is set if more than half
    of ``size`` words have it."""
    return f"""
      aggregate(sequence(0, 31), 0L, (bits, k) ->
        bits | if(2 * (get({lanes}, k) & {(1 << 32) - 1}L) > {size}, shiftleft(1L, k), 0L)
             | if(2 * shiftrightunsigned(get({lanes}, k), 32) > {size}, shiftleft(1L, k + 32), 0L))"""


def _lanes(hashes: str) -> str:
    """SQL of the 64 counters, as 32 longs that add up two bits each."""
    return f"""
      transform(sequence(0, 31), k -> aggregate({hashes}, 0L,
        (acc, h) -> acc + (shiftrightunsigned(h, k) & {_LANES})))"""


def simhash(hashes: str) -> Column:
    """64-bit SimHash of a column of word hashes, by name."""
    return F.expr(_print(_lanes(hashes), f"size({hashes})"))


def simhashes(hashes: str, low: str, high: str, size: str) -> str:
    """SQL of the SimHashes of the windows that start at ``low`` to ``high``."""
    return f"""
      aggregate(sequence({low} + 1, {high} + 1),
        struct({_lanes(f"slice({hashes}, {low} + 1, {size})")} AS lanes, CAST(array() AS array<bigint>) AS prints),
        (state, i) -> struct(
          transform(state.lanes, (t, k) -> t - (shiftrightunsigned(get({hashes}, i - 1), k) & {_LANES})
            + coalesce(shiftrightunsigned(get({hashes}, i - 1 + {size}), k) & {_LANES}, 0L)) AS lanes,
          concat(state.prints, array({_print("state.lanes", f"least({size}, size({hashes}))")})) AS prints),
        state -> state.prints)"""


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def blocks(radius: int = RADIUS) -> list[int]:
    """Bit masks of radius + 1 blocks that cover 64 bits."""
    edges = [round(64 * k / (radius + 1)) for k in range(radius + 2)]
    return [_signed(((1 << (b - a)) - 1) << a) for a, b in zip(edges, edges[1:])]


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(ik, item, size, hashes, shingles) of the distinct items that have a
    shingle; ``ik``, never null, stands for the id and the words."""
    i = benchmark.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    named = F.concat(F.concat_ws(" ", "words"), F.coalesce(F.concat(F.lit("\n="), F.col("item").cast("string")), F.lit("\n")))
    return (i.select(F.unhex(F.md5(named)).alias("ik"), "item", F.size("words").alias("size"),
                     word_hashes(F.col("words")).alias("hashes"), shingles_of(F.col("words")).alias("shingles"))
            .filter(F.col("size") >= WIDTH).dropDuplicates(["ik"]))


def _index(items: DataFrame, least: float) -> DataFrame:
    """(ik, size, s, m, w, total, lead): an item's distinct shingles with count m
    and weight w, and the item's whole weight, both in 1 / UNIT.  A window without
    any ``lead`` shingle, the heaviest, is below ``least``."""
    per = items.select("ik", "size", F.explode("shingles").alias("s")).groupBy("ik", "size", "s").agg(F.count("*").cast("int").alias("m"))
    per = per.join(per.groupBy("s").agg((1 / F.count("*")).alias("raw")), "s")
    of_item = Window.partitionBy("ik")
    per = per.withColumn("w", F.greatest(F.round(F.col("raw") / F.avg("raw").over(of_item) * UNIT).cast("long"), F.lit(1)))
    value = F.col("w") * F.col("m")
    lighter = of_item.orderBy("w", "s").rowsBetween(Window.unboundedPreceding, 0)
    per = per.select("*", F.sum(value).over(of_item).alias("total"), F.sum(value).over(lighter).alias("rest"))
    return per.select("ik", "size", "s", "m", "w", "total", (F.col("rest") >= _enough(least) * F.col("total")).alias("lead"))


def _enough(least: float) -> Column:
    return F.lit(least * (1 - 1e-9))  # weights are rounded to 1 / UNIT


def _window_shingles(size, n) -> Column:
    return F.least(F.col(size), F.col(n)) - (WIDTH - 1)


def _hits(found: DataFrame) -> DataFrame:
    """A row for every place ``pos`` of a shingle that text and item share, with
    ``past``, the place of the same shingle m occurrences earlier."""
    at = F.transform("at", lambda p, r: F.struct(p.alias("pos"), F.when(r >= F.col("m"), F.get("at", r - F.col("m"))).alias("past")))
    return (found.select("key", "ik", "size", "n", "total", "w", F.explode(at).alias("x"))
            .select("key", "ik", "size", "n", "total", "w", "x.*"))


def _runs(places: DataFrame, index: DataFrame, least: float) -> DataFrame:
    """(key, size, n, low, high): runs of starts that cover all windows that can be
    ``least`` similar to an item of their size.  With A the weight of a window's
    shingles that the item has, c their number, N that of all its shingles and T
    the item's weight, the similarity is at most A / (T + N - c)."""
    enough = _enough(least)
    led = places.select("key", "s").join(index.filter("lead").select("s", "ik"), "s").select("key", "ik").distinct()
    hits = _hits(places.join(led, "key").join(index, ["ik", "s"]))
    pair = Window.partitionBy("key", "ik")
    hits = hits.withColumn("all", F.sum("w").over(pair)).filter(F.col("all") >= enough * F.col("total"))
    length = _window_shingles("size", "n")
    event = lambda at, sign: F.struct(at.alias("at"), (sign * F.col("w")).alias("a"), F.lit(sign).alias("c"))
    events = (hits.select("key", "ik", "size", "n", "total",
                          F.explode(F.array(event(F.col("pos") - length + 1, 1), event(F.col("pos") + 1, -1))).alias("e"))
              .select("key", "ik", "size", "n", "total", "e.*"))
    by_place = pair.orderBy("at")
    sums = events.select("key", "size", "n", "total", F.greatest("at", F.lit(0)).alias("low"),
                         F.least(F.lead("at").over(by_place) - 1, F.greatest(F.col("n") - F.col("size"), F.lit(0))).alias("high"),
                         F.sum("a").over(by_place).alias("a"), F.sum("c").over(by_place).alias("c"))
    able = sums.filter((F.col("low") <= F.col("high")) & (F.col("a") >= enough * (F.col("total") + (length - F.col("c")) * UNIT)))
    cell = F.least(F.col("size"), F.lit(RUN))
    able = able.select("key", "size", "n", "low", "high", cell.alias("cell"), F.explode(F.sequence(
        F.floor(F.col("low") / cell).cast("int"), F.floor(F.col("high") / cell).cast("int"))).alias("b"))
    return (able.groupBy("key", "size", "n", "b").agg(
        F.min(F.greatest("low", F.col("b") * F.col("cell"))).alias("low"),
        F.max(F.least("high", (F.col("b") + 1) * F.col("cell") - 1)).alias("high")).drop("b"))


def _similarities(near: DataFrame, places: DataFrame, index: DataFrame) -> DataFrame:
    """``near(key, ik, size, n, start)`` with ``similarity``.  An occurrence of a
    shingle counts in sum of w * min as long as fewer than m of its kind lie before
    it in the window, that is while the window starts behind ``past``."""
    found = (near.select("key", "ik").distinct().join(index.drop("lead"), "ik").join(places, ["key", "s"]))
    length = _window_shingles("size", "n")
    event = lambda at, a, c, both: F.struct(at.alias("at"), a.alias("a"), F.lit(c).alias("c"), both.alias("both"))
    enters, w, none = F.col("pos") - length + 1, F.col("w"), F.lit(0).cast("long")
    events = (_hits(found).select("key", "ik", "total", F.explode(F.array(
        event(enters, w, 1, none), event(F.greatest(F.col("past") + 1, enters), none, 0, w),
        event(F.col("pos") + 1, -w, -1, -w))).alias("e"))
        .select("key", "ik", "total", "e.*", *(F.lit(None).cast("int").alias(c) for c in ("size", "n"))))
    asked = near.select("key", "ik", none.alias("total"), F.col("start").alias("at"), none.alias("a"), F.lit(0).alias("c"),
                        none.alias("both"), "size", "n")
    pair = Window.partitionBy("key", "ik")
    upto = pair.orderBy("at")
    sums = events.unionByName(asked).select(
        "key", "ik", "size", F.col("at").alias("start"), F.max("total").over(pair).alias("total"),
        F.sum("a").over(upto).alias("a"), F.sum("both").over(upto).alias("both"),
        (_window_shingles("size", "n") - F.sum("c").over(upto)).alias("others"), F.col("n").isNotNull().alias("asked"))
    whole = F.col("total") + F.col("a") - F.col("both") + F.col("others") * UNIT
    return sums.filter("asked").select("key", "ik", "size", "start", F.round(F.col("both") / whole, 9).alias("similarity"))


def leaks_by_text(texts: DataFrame, benchmark: DataFrame, item_id: str = "item_id",
                  item_text: str = "text", least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """(key, item, similarity, start, size) of ``texts(key, text)``: the best
    window of each text and item, ``start`` and ``size`` in words; the similarity
    is rounded to nine digits, before it is compared with ``least`` too."""
    items = checkpoint(_items(benchmark, item_id, item_text))
    index = checkpoint(_index(items, least))
    # one row per shingle of the benchmark that a text holds, with all its places
    places = checkpoint(
        texts.select("key", words_of(F.col("text")).alias("words"))
        .select("key", F.size("words").alias("n"), F.posexplode(shingles_of(F.col("words"))).alias("pos", "s"))
        .join(index.select("s").distinct(), "s", "left_semi")
        .groupBy("key", "n", "s").agg(F.array_sort(F.collect_set("pos")).alias("at")))
    wanted = checkpoint(_runs(places, index, least).groupBy("key").agg(F.collect_list(F.struct("size", "n", "low", "high")).alias("wanted")))
    docs = (texts.join(wanted, "key").dropDuplicates(["key"]).select("key", words_of(F.col("text")).alias("words"), "wanted")
            .select("key", word_hashes(F.col("words")).alias("hashes"), "wanted"))
    prints = F.expr("transform(wanted, x -> struct(x.size, x.n, x.low, "
                    + simhashes("hashes", "x.low", "x.high", "x.size") + " AS prints))")
    windows = checkpoint(
        docs.select("key", F.explode(prints).alias("x")).select("key", "x.size", "x.n", "x.low", F.posexplode("x.prints").alias("k", "print"))
        .select("key", "size", "n", (F.col("low") + F.col("k")).alias("start"), "print"))
    masks = blocks(radius)
    block = lambda p: F.posexplode(F.array(*(p.bitwiseAND(F.lit(m)) for m in masks)))
    known = items.select("ik", F.col("size").alias("z"), simhash("hashes").alias("q")).select(
        "ik", "z", "q", block(F.col("q")).alias("j", "bits_j"))
    seen = windows.select("*", block(F.col("print")).alias("k", "bits_k"))
    differ = F.col("print").bitwiseXOR(F.col("q"))
    first_equal = F.coalesce(*(F.when(differ.bitwiseAND(F.lit(m)) == 0, n) for n, m in enumerate(masks)))
    near = checkpoint(seen.join(known, (F.col("size") == F.col("z")) & (F.col("k") == F.col("j"))
                                & (F.col("bits_k") == F.col("bits_j")) & (F.bit_count(differ) <= radius)
                                & (first_equal == F.col("k"))).select("key", "ik", "size", "n", "start"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "size")).alias("b")
    return (_similarities(near, places, index).filter(F.col("similarity") >= least).groupBy("key", "ik").agg(best)
            .join(items.select("ik", "item"), "ik")
            .select("key", "item", "b.similarity", (-F.col("b.s")).alias("start"), "b.size"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **settings) -> DataFrame:
    """(id, item, similarity, start, size) per contaminated document and item."""
    own = docs.select(F.col(id_col).alias("id"), F.sha2(F.col(text_col), 256).alias("key"), F.col(text_col).alias("text"))
    found = leaks_by_text(own.select("key", "text"), benchmark, **settings)
    return own.select("id", "key").distinct().join(found, "key").drop("key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; columns as they were."""
    texts = docs.select(F.sha2(F.col(text_col), 256).alias("key"), F.col(text_col).alias("text"))
    gone = fresh(docs, "_leak")
    found = checkpoint(leaks_by_text(texts, benchmark, **settings).select(F.col("key").alias(gone)).distinct())
    return docs.join(found, F.sha2(F.col(text_col), 256) == F.col(gone), "left_anti")


def op9_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(documents, benchmark).select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.round("similarity", 6).alias("similarity"),
        F.col("start").alias("start_word"), F.col("size").alias("n_words"))
