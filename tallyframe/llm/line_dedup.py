"""Line deduplication by a suffix array over line sequences, with DataFrame functions only.

Every line is a letter.  Lines that occur once can be in no repeated run and
are left out; the places of all others get their rank among the sorted
suffixes by distributed prefix doubling: the rank by ``2k`` lines refines the
rank by ``k`` lines with the rank ``k`` lines further on.  Suffixes that share
their first ``m`` lines are one interval of the suffix array whose longest
common prefix is ``m`` lines at least, named by two overlapping ranks.

A run counts as a passage from ``min_words`` words.  Each place is tested with
the shortest window of so many words that starts there and the shortest that
ends there; a run of more words is repeated exactly if all such windows in it
are, and they overlap to cover all of it, so maximal runs are found without
growing the prefixes beyond ``min_words`` lines, however long the copies are
(the tests hold this to a search for maximal runs; :func:`repeated_runs` names
them).  In each interval the first copy, by id and then line, stays, and the
lines of every later copy are deleted; a copy that overlaps the first one in
the same document loses the lines beyond it.  So each distinct line stays at
least once.

No window, join or group gathers a frequent line: its places are counted before
the shuffle, ranks are summed in value ranges, and joins have one row per rank
on one side, so that AQE can split the other.

Defined results: lines are compared without their outer white space; lines
without words are no letters and stay; null text stays null; null ids sort
last, repeated ids by their order in the written input; every row stays, with
what is left of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, written
from .quality_rules import SPACE, _words

MIN_WORDS = 50
#: Value ranges in which ranks are summed up before the ranges themselves are: at least so many, one more for
#: each ``RANGE_ROWS`` places that repeat; and for keys.
RANGES, RANGE_ROWS = 64, 100_000
KEY_RANGES = 1 << 14

_BEFORE = (Window.unboundedPreceding, -1)


def _offsets(rows: DataFrame, group: list[str], range_col: str, order: list[str], count: str) -> DataFrame:
    """Adds ``before``: the sum of ``count`` over rows of the same group that sort earlier.

    ``range_col`` must not fall as ``order`` rises; a group is summed in ranges, then over them.
    """
    parts = rows.groupBy(*group, range_col).agg(F.sum(count).alias("part"))
    parts = parts.withColumn("earlier", F.coalesce(F.sum("part").over(Window.partitionBy(*group).orderBy(range_col).rowsBetween(*_BEFORE)), F.lit(0))).drop("part")
    inner = Window.partitionBy(*group, range_col).orderBy(*order).rowsBetween(*_BEFORE)
    placed = rows.withColumn("within", F.coalesce(F.sum(count).over(inner), F.lit(0)))
    return placed.join(parts, [*group, range_col]).withColumn("before", F.col("earlier") + F.col("within")).drop("earlier", "within")


def _letters(base: DataFrame) -> DataFrame:
    """``(uid, p, q, n, h, g)``: line number, number among lines with words, words, and a 128-bit key."""

    def letter(x: Column, p: Column) -> Column:
        line = F.btrim(x, F.lit(SPACE))
        return F.struct(p.alias("p"), F.size(_words(x)).alias("n"), F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g"))

    found = F.filter(F.transform(F.split("text", "\n"), letter), lambda s: s["n"] > 0)
    return base.select("uid", F.posexplode(found).alias("q", "s")).select("uid", "q", "s.*")


def _first_ranks(letters: DataFrame) -> DataFrame:
    """``(h, g, rank)`` of every key that occurs twice or more: how many places sort before its own."""
    keys = letters.groupBy("h", "g").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    keys = keys.withColumn("one", F.lit(0)).withColumn("range", F.floor((F.col("h") / 2.0**64 + 0.5) * KEY_RANGES))
    return _offsets(keys, ["one"], "range", ["h", "g"], "c").select("h", "g", F.col("before").alias("rank"))


def _shortest(places: str, at: Column, min_words: int, forward: bool) -> Column:
    """Lines of the shortest run of ``min_words`` words that starts (or ends) at place ``at``; null if there is none."""
    start = at + 1 if forward else F.greatest(at + 2 - min_words, F.lit(1))
    length = F.lit(min_words) if forward else at + 2 - start
    run = F.slice(places, start, length)
    run = run if forward else F.reverse(run)
    q = F.get(F.col(places), at)["q"]
    step = 1 if forward else -1

    def add(acc: Column, x: Column) -> Column:
        grows = (acc["words"] < min_words) & (x["q"] == q + step * acc["m"])
        return F.struct((acc["words"] + F.when(grows, x["n"]).otherwise(0)).alias("words"), (acc["m"] + grows.cast("int")).alias("m"))

    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("m"))
    return F.aggregate(run, zero, add, lambda acc: F.when(acc["words"] >= min_words, acc["m"]))


def _windows(places: str, min_words: int) -> Column:
    """Windows (i, m) of a document: the shortest from each place and the shortest to each place."""
    numbers = F.when(F.size(places) > 0, F.sequence(F.lit(0), F.size(places) - 1)).otherwise(F.array().cast("array<int>"))

    def ending(e: Column) -> Column:
        m = _shortest(places, e, min_words, forward=False)
        return F.struct((e - m + 1).alias("i"), m.alias("m"))

    starting = F.transform(numbers, lambda i: F.struct(i.alias("i"), _shortest(places, i, min_words, forward=True).alias("m")))
    return F.filter(F.array_distinct(F.concat(starting, F.transform(numbers, ending))), lambda w: w["m"].isNotNull())


def _pair(k: int):
    """Of a place: its rank by ``2**k`` lines and that of the place as many lines on, -1 if the run breaks before."""
    ahead = 1 << k

    def pair(x: Column, i: Column) -> Column:
        other = F.get("places", i + ahead)
        second = F.when(other["q"] == x["q"] + ahead, other["ranks"][k])
        return F.struct(x["ranks"][k].alias("a"), F.coalesce(second, F.lit(-1).cast("long")).alias("b"))

    return pair


def suffix_ranks(base: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, str]:
    """``(uid, places array<struct<q, p, n, ranks>>, windows array<struct<i, m>>)`` of documents with a window, and its folder.

    ``ranks[k]`` is a place's rank in the suffix array by its first ``2**k`` lines.
    """
    spark = base.sparkSession
    letters, letters_path = written(_letters(base), "line-letters")
    ranks, ranks_path = written(_first_ranks(letters), "line-ranks")
    place = F.struct("q", "p", "n", F.array("rank").alias("ranks"))
    grouped = letters.join(ranks, ["h", "g"]).groupBy("uid").agg(F.sort_array(F.collect_list(place)).alias("places"))
    grouped = grouped.withColumn("windows", _windows("places", min_words)).where(F.size("windows") > 0)
    state, path = written(grouped, "line-places")
    discard(spark, letters_path)
    longest = state.agg(F.max(F.array_max("windows.m"))).first()[0] or 0
    top = ranks.agg(F.max("rank")).first()[0]
    ranges = RANGES + (top or 0) // RANGE_ROWS
    k = 0
    while 2 << k <= longest:
        pairs = state.select("uid", F.posexplode(F.transform("places", _pair(k))).alias("i", "s")).select("uid", "i", "s.*")
        counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
        counted = counted.withColumn("range", F.floor((F.col("b") + 1.0) * ranges / (top + 2.0)))
        refined = _offsets(counted, ["a"], "range", ["b"], "c").select("a", "b", (F.col("a") + F.col("before")).alias("rank"))
        new = pairs.join(refined, ["a", "b"]).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("i", "rank"))).alias("new"))
        longer = F.zip_with("places", "new", lambda x, y: F.struct(x["q"].alias("q"), x["p"].alias("p"), x["n"].alias("n"), F.concat(x["ranks"], F.array(y["rank"])).alias("ranks")))
        old_path = path
        state, path = written(state.join(new, "uid").select("uid", longer.alias("places"), "windows"), "line-places")
        discard(spark, old_path)
        k += 1
    discard(spark, ranks_path)
    return state, path


def _later_windows(base: DataFrame, min_words: int) -> DataFrame:
    """``(uid, i, m, q, lines, first)``: windows of documents that stand at an earlier place ``first`` (doc, i, q, line) too."""
    state, path = suffix_ranks(base, min_words)
    window = F.explode("windows").alias("w")
    level = F.floor(F.log2(F.col("w.m") + 0.5)).cast("int")
    rank = lambda i: F.get(F.get(F.col("places"), i)["ranks"], F.col("level"))
    named = (
        state.select("uid", "places", window)
        .withColumn("level", level)
        .select(
            "uid",
            F.col("w.i").alias("i"),
            F.col("w.m").alias("m"),
            F.get("places", F.col("w.i"))["q"].alias("q"),
            rank(F.col("w.i")).alias("a"),
            rank(F.col("w.i") + F.col("w.m") - F.pow(F.lit(2), F.col("level")).cast("int")).alias("b"),
            F.transform(F.slice("places", F.col("w.i") + 1, F.col("w.m")), lambda x: x["p"]).alias("lines"),
        )
    )
    order = base.select("uid", F.struct(F.col("id").isNull().alias("none"), "id", "uid").alias("doc"))
    named = materialise(named.join(order, "uid"), "line-windows")
    discard(base.sparkSession, path)
    # windows of one name are an interval of the suffix array
    first = named.groupBy("m", "a", "b").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "i", "q", F.col("lines")[0].alias("line"))).alias("first")).where("copies > 1")
    return named.join(first, ["m", "a", "b"]).where(F.struct("doc", "i") > F.struct("first.doc", "first.i")).select("uid", "i", "m", "q", "lines", "first")


def later_copies(base: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(uid, removed array<int>)``: line numbers of each document that belong to a later copy."""
    later = _later_windows(base, min_words)
    beyond = F.when(F.col("first.doc.uid") == F.col("uid"), F.greatest(F.lit(0), F.col("first.i") + F.col("m") - F.col("i"))).otherwise(0)
    gone = later.select("uid", F.explode(F.slice("lines", beyond + 1, F.col("m"))).alias("line"))
    return gone.groupBy("uid").agg(F.collect_set("line").alias("removed"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, start_line, end_line, first_id, first_line)``: maximal runs of lines of a document that repeat those of a first copy.

    Windows of a document whose first copies follow each other in one document
    are one run.  Lines are numbered from 0.
    """
    base = materialise(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), "line-input")
    later = _later_windows(base, min_words).select("uid", "q", "m", "lines", F.col("first.doc").alias("from"), (F.col("first.q") - F.col("q")).alias("shift"), F.col("first.line").alias("first_line"))
    group = Window.partitionBy("uid", "from", "shift").orderBy("q", "m")
    begins = F.coalesce((F.col("q") > F.max(F.col("q") + F.col("m")).over(group.rowsBetween(*_BEFORE))).cast("int"), F.lit(1))
    runs = later.withColumn("begins", begins).withColumn("run", F.sum("begins").over(group.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("uid", "from", "shift", "run").agg(F.min(F.col("lines")[0]).alias("start_line"), F.max(F.element_at("lines", -1)).alias("end_line"), F.min("first_line").alias("first_line"))
    return found.join(base.select("uid", "id"), "uid").select(F.col("id").alias(id_col), "start_line", "end_line", F.col("from.id").alias("first_id"), "first_line")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id_col, keep..., text_col, n_lines, n_removed)``: every document without its later copies of passages."""
    columns = [F.col(c).alias(f"keep{k}") for k, c in enumerate(keep)]
    base = materialise(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), *columns), "line-input")
    gone = later_copies(base, min_words).select(F.col("uid").alias("of"), "removed")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    out = base.join(gone, base.uid == gone.of, "left").withColumn("lines", lines)
    return out.select(
        F.col("id").alias(id_col),
        *[F.col(f"keep{k}").alias(c) for k, c in enumerate(keep)],
        text.alias(text_col),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


ORACLE_SQL = f"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, unnest(range(len(ls))) AS p, unnest(ls) AS raw FROM s),
y AS (SELECT doc_id, p, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM x),
l AS (SELECT doc_id, p, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS q FROM y WHERE line <> ''),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY q) AS upto FROM l),
fw AS (SELECT a.doc_id, a.q AS i, min(b.q) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.q BETWEEN a.q AND a.q + {MIN_WORDS} AND b.upto - a.upto + a.n >= {MIN_WORDS} GROUP BY 1, 2),
bw AS (SELECT b.doc_id, max(a.q) AS i, b.q AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.q BETWEEN b.q - {MIN_WORDS} AND b.q AND b.upto - a.upto + a.n >= {MIN_WORDS} GROUP BY 1, 3),
w AS (SELECT * FROM fw UNION SELECT * FROM bw),
t AS (SELECT w.doc_id, i, e, string_agg(line, chr(10) ORDER BY q) AS run FROM w JOIN c ON c.doc_id = w.doc_id AND q BETWEEN i AND e GROUP BY 1, 2, 3),
f AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(i) OVER o AS fi FROM t WINDOW o AS (PARTITION BY run ORDER BY doc_id, i)),
g AS (SELECT DISTINCT f.doc_id, p FROM f JOIN c ON c.doc_id = f.doc_id AND q BETWEEN CASE WHEN fd = f.doc_id THEN greatest(i, fi + (e - i + 1)) ELSE i END AND e WHERE fd <> f.doc_id OR fi <> i),
r AS (SELECT doc_id, list(p) AS ps FROM g GROUP BY 1)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(len(ps), 0)::BIGINT AS n_removed,
  array_to_string([z[2] FOR z IN list_zip(range(len(ls)), ls) IF ps IS NULL OR NOT list_contains(ps, z[1])], chr(10)) AS text
FROM s LEFT JOIN r USING (doc_id)
"""
