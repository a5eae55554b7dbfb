"""Texts that were cut off by a field limit or in transfer.

A text that does not end in a closing sign is a candidate. Four kinds of evidence
from the corpus decide, each enough by itself:

* a trie of all words has the last word as a proper prefix of known words, but not as a word;
* the text's length is one at which the source's open-ended texts pile up;
* a model of line ends, scored for the last line, says that lines of its kind don't end without a closing sign;
* the last word, or the last line's beginning, goes on in the corpus where this text stops.

Last lines that close many open-ended texts are sign-offs and no case. Evidence is
taken from shares and from distinct lines, so that repeated texts change no
verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: What closes a text: a sentence sign, quotes and brackets after it, a bracket, or a quote that has its opening partner. An apostrophe after a letter opens none.
SIGNS = ".!?؟…۔。"
AFTER_SIGN = "'\"”»’)]"
QUOTED = r"(?:«[^«»]*(?:«[^«»]*»[^«»]*)*»|[“\"„][^”“\"]*”|‘[^’]*+(?:(?<=[\p{L}\p{M}])’(?=\p{L})[^’]*+)*+’|(?:^|[\s(\[«“\"])'(?=\S)[^'\n]*+(?:(?<=[\p{L}\p{M}])'(?=\p{L})[^'\n]*+)*+')$"
#: A sentence that ends within a line.
INNER_END = r"[.!?؟…۔。]['\"”»’)\]]*\s"
#: Stands for any token in a line shape; no token is blank.
SLOT = " "
#: All white space of Unicode.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = r"[^\p{L}\p{M}]+"
#: A line that closes at least this share of the open-ended texts, and this many, is a sign-off.
SIGN_OFF_SHARE, SIGN_OFF_LEAST = 0.001, 3
#: A word that hardly ever ends an open line, though by its share of all words it would end this many distinct ones, cannot end one by design.
EXPECTED = 5.0
#: Of the ends that a word should have by its share, those that may be strays.
STRAY_WORD = 0.05
#: A token with this share of all tokens in open lines is a fixed part of line shapes; others are slots. At most 1 / FIXED_SHARE are fixed.
FIXED_SHARE = 0.0025
#: A first or second token with this share of all such is told apart by the model of line ends. At most 1 / TOKEN_SHARE are.
TOKEN_SHARE = 0.0005
#: Before any line is seen: the odds that a line ends without a closing sign by design.
PRIOR_ODDS = 0.001
#: A beginning that this many distinct lines have recurs; at most this share of them may end where it is judged to be cut.
SHAPE_LEAST, STRAY_LINE = 20, 0.02
#: Different open-ended texts of one source and length: this many, and this many times what the lengths next to it, up to each of these distances, have on average, make a limit.
LIMIT_LEAST, LIMIT_TIMES, LIMIT_NEAR = 5, 8.0, (8, 32)
#: A limit in bytes that meets a character's inside leaves up to 3 bytes less, or up to 2 more if a replacement character stands for it.
LESS, MORE = 3, 2


def _closed(text: Column) -> Column:
    """Whether a text or line ends in a closing sign."""
    last = F.right(text, F.lit(1))
    core = F.right(F.rtrim(text, F.lit(AFTER_SIGN)), F.lit(1))
    paired = (last == '"') & (F.length(F.regexp_replace(text, '[^"]+', "")) % 2 == 0)
    return core.isin(*SIGNS) | last.isin(")", "]") | (last.isin("'", '"', "»", "”", "’") & (paired | text.rlike(QUOTED)))


def _ended(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def _lines(text: Column) -> Column:
    """The lines that are not blank, without white space around them."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(WHITE))), lambda x: x != "")


def _last_word(line: Column) -> Column:
    return F.lower(F.regexp_extract(line, r"([\p{L}\p{M}]+)[^\p{L}\p{M}]*$", 1))


def _traits(lines: Column, closed: Column, i: Column) -> dict[str, Column]:
    """What the model knows of line ``i`` before its end."""
    line = F.get(lines, i)
    first = F.substring_index(line, " ", 1)
    return {
        "before": F.when(i == 0, "start").when(F.get(closed, i - 1), "closed").otherwise("open"),
        "inner": line.rlike(INNER_END),
        "first": first,
        "second": F.when(line == first, "").otherwise(F.substring_index(F.substring_index(line, " ", 2), " ", -1)),
    }


def candidates(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Texts that end without a closing sign, with what their end looks like."""
    bodies = docs.select(F.col(key), F.col(source).alias("_source"), F.col(text).alias("_text"), _ended(F.col(text)).alias("_body"))
    open_ended = bodies.filter((F.col("_body") != "") & ~_closed(F.col("_body"))).withColumn("_lines", _lines(F.col("_body")))
    flagged = open_ended.withColumn("_ends", F.transform("_lines", _closed)).withColumn("_line", F.element_at("_lines", -1))
    traits = _traits(F.col("_lines"), F.col("_ends"), F.size("_lines") - 1)
    return flagged.select(
        key,
        "_source",
        "_line",
        _last_word(F.col("_line")).alias("_word"),
        F.right("_line", F.lit(1)).rlike(r"[\p{L}\p{M}]").alias("_in_word"),
        F.xxhash64("_body").alias("_hash"),
        F.length("_text").alias("_chars"),
        F.octet_length("_text").alias("_bytes"),
        *[c.alias(f"_{n}") for n, c in traits.items()],
    )


def vocabulary(docs: DataFrame, text: str, ends: DataFrame) -> DataFrame:
    """(word, n): the words of all texts but for those that ``ends`` has as the last of a text, which may be cut.

    Runs between blanks are counted first, so that only distinct ones are split into words.
    """
    # explode_outer, as for explode the planner adds a filter that splits every text again.
    runs = docs.select(F.explode_outer(F.split(text, " ")).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    inside = runs.select(F.explode_outer(F.split(F.lower("run"), LETTERS)).alias("word"), "n").filter("word <> ''")
    finals = ends.filter("_in_word AND _word <> ''").select(F.col("_word").alias("word"), F.lit(-1).cast("long").alias("n"))
    return inside.unionByName(finals).groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def trie(words: DataFrame) -> DataFrame:
    """(node, below): every proper prefix of a word with the number of words below it."""
    ways = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", F.lit(1), i))
    return words.filter(F.length("word") > 1).select(F.explode(ways).alias("node")).groupBy("node").agg(F.count("*").alias("below"))


def inner_lines(docs: DataFrame, text: str) -> DataFrame:
    """(before, inner, first, second, line, times): all lines but for each text's last, by what the model knows of them; ``line`` is the whole line if it is open, null if closed."""
    split = docs.filter(F.col(text).contains("\n")).select(_lines(F.col(text)).alias("_lines"))
    flagged = split.withColumn("_ends", F.transform("_lines", _closed))

    def one(i: Column) -> Column:
        traits = _traits(F.col("_lines"), F.col("_ends"), i)
        return F.struct(*[c.alias(n) for n, c in traits.items()], F.when(~F.get("_ends", i), F.get("_lines", i)).alias("line"))

    each = F.when(F.size("_lines") > 1, F.transform(F.sequence(F.lit(0), F.size("_lines") - 2), one))
    rows = flagged.select(F.explode_outer(each).alias("x")).filter("x IS NOT NULL").select("x.*")
    return rows.groupBy("before", "inner", "first", "second", "line").agg(F.count("*").alias("times"))


class LineEnds:
    """The odds that a line ends without a closing sign by design: naive Bayes over what is known of it before its end.

    What counts is how the line before ends, whether a sentence ends within the
    line, and its first and second token, if they are common enough. Open lines
    count once however often they occur. Without any line the odds are PRIOR_ODDS.
    """

    def __init__(self, lines: DataFrame):
        self.spark = lines.sparkSession
        is_open = F.col("line").isNotNull()
        n_open, n_closed = F.count_if(is_open), F.sum(F.when(is_open, 0).otherwise(F.col("times")))
        traits = F.array(*[F.struct(F.lit(k).alias("trait"), F.col(k).cast("string").alias("value")) for k in ("before", "inner", "first", "second")])
        counts = lines.withColumn("t", F.explode(traits)).groupBy("t.trait", "t.value").agg(n_open.alias("o"), n_closed.alias("c"))
        total = lines.agg(n_open.alias("o"), n_closed.alias("c")).first()
        self.o, self.c = total.o or 0, total.c or 0
        # At most 1 / TOKEN_SHARE rows for first and second each, and five others.
        rows = counts.filter(~F.col("trait").isin("first", "second") | (F.col("o") + F.col("c") >= max(2.0, TOKEN_SHARE * (self.o + self.c)))).collect()
        self.weight = {(r.trait, r.value): self._ratio(r.o, r.c) for r in rows}
        self.rest = {}
        for t in ("first", "second"):
            known = [r for r in rows if r.trait == t]
            self.rest[t] = self._ratio(self.o - sum(r.o for r in known), self.c - sum(r.c for r in known))
        self.start = math.log((self.o + PRIOR_ODDS) / (self.c + 1))

    def _ratio(self, o: int, c: int) -> float:
        return math.log((o + 0.5) / (self.o + 1)) - math.log((c + 0.5) / (self.c + 1))

    def score(self, ends: DataFrame, out: str = "_score") -> DataFrame:
        """``ends`` with the logarithm of the odds for the columns _before, _inner, _first and _second."""
        total = F.lit(self.start)
        for t in ("before", "inner"):
            column = F.col(f"_{t}").cast("string")
            total = total + F.coalesce(*[F.when(column == v, F.lit(w)) for (k, v), w in self.weight.items() if k == t], F.lit(0.0))
        for t in ("first", "second"):
            table = self.spark.createDataFrame([(v, w) for (k, v), w in self.weight.items() if k == t], f"w_{t} string, v_{t} double")
            ends = ends.join(F.broadcast(table), F.col(f"_{t}") == F.col(f"w_{t}"), "left")  # at most 1 / TOKEN_SHARE rows
            total = total + F.coalesce(f"v_{t}", F.lit(self.rest[t]))
        return ends.withColumn(out, total).drop("w_first", "v_first", "w_second", "v_second")


def line_ends(lines: DataFrame) -> DataFrame:
    """(word, ends): the words that end open lines."""
    return lines.select(_last_word(F.col("line")).alias("word"), "times").groupBy("word").agg(F.sum("times").alias("ends"))


def _tokens(line: Column) -> Column:
    return F.split(F.lower(F.trim(line)), r"\s+")


def shape_prefixes(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """(begins, next, lines, stops): for each beginning of a line shape and the token after it, the distinct lines that have it and that end with it; the fixed tokens."""
    tokens = lines.select(F.explode(_tokens(F.col("line"))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    total = tokens.agg(F.sum("n")).first()[0] or 0
    fixed = sorted(r.t for r in tokens.filter(F.col("n") >= max(1.0, FIXED_SHARE * total)).select("t").collect())  # at most 1 / FIXED_SHARE
    at = lines.select(_shape(F.col("line"), fixed).alias("s")).select("s", F.posexplode("s").alias("i", "next"))
    begins = F.concat_ws(" ", F.slice("s", F.lit(1), F.col("i")))
    return at.groupBy(begins.alias("begins"), "next").agg(F.count("*").alias("lines"), F.count_if(F.col("i") + 1 == F.size("s")).alias("stops")), fixed


def _shape(line: Column, fixed: list[str]) -> Column:
    return F.transform(_tokens(line), lambda x: F.when(x.isin(fixed), x).otherwise(SLOT))


def begun_shapes(styled: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """(key): texts whose last line begins a recurring shape and stops where that goes on."""
    shapes, fixed = shape_prefixes(lines)
    s = _shape(F.col("_line"), fixed)
    ends = styled.select(key, F.concat_ws(" ", F.slice(s, F.lit(1), F.size(s) - 1)).alias("_begins"), F.element_at(_tokens(F.col("_line")), -1).alias("_token"))
    ends = ends.filter("_begins <> ''")
    met = ends.join(shapes, (F.col("_begins") == F.col("begins")) & ((F.col("next") == SLOT) | F.col("next").startswith(F.col("_token"))))
    found = met.groupBy(key).agg(F.sum("lines").alias("lines"), F.sum("stops").alias("stops"))
    return found.filter((F.col("lines") >= SHAPE_LEAST) & (F.col("stops") <= STRAY_LINE * F.col("lines"))).select(key)


def limits(ends: DataFrame) -> DataFrame:
    """(_source, unit, size): lengths at which a source's different open-ended texts pile up."""
    sizes = ends.select("_source", "_hash", F.explode(F.map_from_arrays(F.array(F.lit("chars"), F.lit("bytes")), F.array("_chars", "_bytes"))).alias("unit", "size")).distinct()
    counts = sizes.groupBy("_source", "unit", "size").agg(F.count("*").alias("n"))
    near = Window.partitionBy("_source", "unit").orderBy("size")  # a row for each length that occurs

    def around(far: int) -> Column:
        both = (F.coalesce(F.sum("n").over(near.rangeBetween(lo, hi)), F.lit(0)) for lo, hi in ((-far, -1), (1, far)))
        return sum(both) / F.lit(2.0 * far)

    mean = F.greatest(*map(around, LIMIT_NEAR))
    return counts.withColumn("_mean", mean).filter((F.col("n") >= LIMIT_LEAST) & (F.col("n") >= LIMIT_TIMES * F.col("_mean"))).select("_source", "unit", "size")


def at_limit(ends: DataFrame, undesigned: DataFrame, key: str) -> DataFrame:
    """(key, _full): texts of just the length of a limit (2), or of nearly that of one in bytes (1).

    Limits are those of the ``undesigned`` among the texts: by design, many texts may have one length.
    """
    spread = F.when(F.col("unit") == "bytes", F.sequence(F.lit(-LESS), F.lit(MORE))).otherwise(F.array(F.lit(0)))
    full = limits(undesigned).select(F.col("_source").alias("s"), "unit", "size", F.explode(spread).alias("off")).select("s", "unit", (F.col("size") + F.col("off")).alias("size"), F.when(F.col("off") == 0, 2).otherwise(1).alias("_full"))
    units = F.array(F.struct(F.lit("chars").alias("u"), F.col("_chars").alias("z")), F.struct(F.lit("bytes").alias("u"), F.col("_bytes").alias("z")))
    at = ends.select(key, "_source", F.explode(units).alias("_m"))
    same = F.col("_source").eqNullSafe(F.col("s")) & (F.col("_m.u") == F.col("unit")) & (F.col("_m.z") == F.col("size"))
    return at.join(full, same).groupBy(key).agg(F.max("_full").alias("_full"))


def find_truncated(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(key, source, reason) of each text that was cut.

    ``reason`` is the first that holds of ``prefix`` (trie), ``limit`` (length),
    ``line`` (model of line ends) and ``mid_line`` (last word or beginning of the
    last line). Null, empty and blank texts are not cut. A null source is a source
    of its own. Rows that repeat give one row. Texts are read whole. An empty table
    gives an empty result.
    """
    ends = stage(candidates(docs, key, text, source), "ends")
    total = ends.count()
    signs = ends.groupBy("_line").agg(F.countDistinct("_hash").alias("n")).filter(F.col("n") >= max(SIGN_OFF_LEAST, SIGN_OFF_SHARE * total)).select("_line")
    words = stage(vocabulary(docs, text, ends), "vocabulary")
    finals = ends.filter("_word <> ''").select(F.col("_word").alias("f")).distinct()
    nodes = trie(words).join(finals, F.col("node") == F.col("f"), "left_semi")
    known = words.join(finals, F.col("word") == F.col("f"), "left_semi")
    every = stage(inner_lines(docs, text), "lines")
    lines = every.filter("line IS NOT NULL").groupBy("line").agg(F.sum("times").alias("times"))
    by_line = line_ends(lines).withColumnRenamed("word", "lw")
    n_lines, n_ends = lines.agg(F.count("*"), F.sum("times")).first()
    n_words = max(1, words.agg(F.sum("n")).first()[0] or 0)
    rate = (n_ends or 0) / n_words
    unsigned = stage(LineEnds(every).score(ends.join(F.broadcast(signs), "_line", "left_anti")), "scored")  # at most 1 / SIGN_OFF_SHARE signs
    by_design = F.col("_score") > 0
    begun = begun_shapes(unsigned.filter(by_design), lines, key).withColumn("_begun", F.lit(True))
    seen = (
        unsigned.join(nodes, F.col("_word") == F.col("node"), "left")
        .join(known, F.col("_word") == F.col("word"), "left")
        .join(by_line, F.col("_word") == F.col("lw"), "left")
        .join(begun, key, "left")
        .join(at_limit(unsigned, unsigned.filter(~by_design), key), key, "left")
    )
    reason = (
        F.when(F.col("n").isNull() & (F.col("below") > 0), "prefix")
        .when((F.col("_full") == 2) | (F.col("_full") == 1) & ~by_design, "limit")
        .when(~by_design, "line")
        .when((F.col("n") * F.lit(n_lines / n_words) >= EXPECTED) & (F.coalesce("ends", F.lit(0)) <= F.col("n") * F.lit(rate * STRAY_WORD)), "mid_line")
        .when(F.col("_begun"), "mid_line")
    )
    cut = seen.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(key, "_source", "reason")
    return cut.withColumnRenamed("_source", source).distinct()
