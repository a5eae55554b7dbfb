"""Sources mixed by temperature: token shares under one exponent, within repetition limits.

The weights of all sources are their token shares raised to one exponent and
normalised. The exponent is bisected until the weights have the entropy of the
target shares; where a total is asked for that the repetition limits do not allow
at these weights, it is bisected on towards 1 until they hold. The weights are
realised as budgeted block permutations: each pass over a source is a permutation
of its documents, cut at the source's budget of tokens, and split into blocks that
hold the same share of every source's budget, so that any stretch of whole blocks
has the weights of the mix.

One exponent can't meet a free share for each source. ``target_weights`` are the
weights that do, over the same realisation, and ``share_report`` says how far
either goes.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the tokenizer's own pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents that one task sorts at most, on average, to find their place in a pass.
BUCKET_ROWS = 50_000
#: Blocks of a mix; each holds this part of every source's budget.
BLOCKS = 64
#: The exponent's range; above 1 it sharpens the shares.
MOST_EXPONENT = 16.0
REMEMBERED = 200_000
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")


#: Contents of tokenizer files, where a driver has sent them; elsewhere they are read.
_SENT: dict[str, bytes] = {}


@lru_cache(maxsize=2)
def _encoding(path: str):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, (_SENT.get(path) or Path(path).read_bytes()).splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Counts(dict):
    """Tokens of a piece between white space; the pattern never crosses one, so a text's are their sum."""

    def __init__(self, path: str):
        self.encoding = _encoding(path)

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n


@lru_cache(maxsize=2)
def _counter(path: str) -> _Counts:
    return _Counts(path)


def count_tokens(text: str, path: str = TOKENIZER) -> int:
    return sum(map(_counter(path).__getitem__, _CHUNK.findall(text)))


def sizes(docs: DataFrame, key: str, text: str, source: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(key, source, n_tokens); null texts have none. Keys that repeat count once, with their largest text.

    The tokenizer's file, some 1 MB, is read by the driver and sent to the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())

    @F.pandas_udf("long")
    def tokens(t: pd.Series) -> pd.Series:
        _SENT.setdefault(tokenizer, shared.value)
        return pd.Series([0 if x is None else count_tokens(x, tokenizer) for x in t], dtype="int64")

    sized = docs.select(F.col(key), F.col(source), tokens(text).alias("n_tokens"))
    return sized.groupBy(key).agg(F.max(F.struct("n_tokens", F.col(source).alias("s"))).alias("m")).select(key, F.col("m.s").alias(source), F.col("m.n_tokens").alias("n_tokens"))


def bisect(f, lo: float, hi: float, steps: int = 200) -> float:
    """Where the falling function f crosses zero, within [lo, hi]."""
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) > 0 else (lo, mid)
    return (lo + hi) / 2


def powered(shares: dict[str, float], exponent: float) -> dict[str, float]:
    top = max(shares.values())
    raw = {s: (p / top) ** exponent for s, p in shares.items()}
    return {s: r / sum(raw.values()) for s, r in raw.items()}


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def most_tokens(totals: dict[str, int], weights: dict[str, float], repeats: dict[str, int]) -> float:
    """The largest total at which no source is repeated more often than allowed."""
    return min(repeats[s] * totals[s] / w for s, w in weights.items() if w > 0)


def temperature(totals: dict[str, int], repeats: dict[str, int], target_entropy: float, total: float | None = None) -> tuple[float, dict[str, float], float]:
    """(exponent, weights, total tokens) of one exponent on the token shares.

    The exponent gives the weights the target entropy, or the nearest they can have.
    Without ``total`` as many tokens are taken as the repetition limits allow. A
    larger ``total`` moves the exponent towards 1, where limits are loosest for small
    sources, until it is allowed; if it is not even there, it is reduced.
    ``totals`` and ``repeats`` are positive, with the same sources.
    """
    everything = sum(totals.values())
    shares = {s: t / everything for s, t in totals.items()}
    a = bisect(lambda x: entropy(powered(shares, x)) - target_entropy, 0.0, MOST_EXPONENT)
    most = most_tokens(totals, powered(shares, a), repeats)
    if total is None or total <= most:
        return a, powered(shares, a), most if total is None else total
    short, enough = a, 1.0
    for _ in range(200):
        mid = (short + enough) / 2
        short, enough = (short, mid) if most_tokens(totals, powered(shares, mid), repeats) >= total else (mid, enough)
    weights = powered(shares, enough)
    return enough, weights, min(total, most_tokens(totals, weights, repeats))


def target_weights(totals: dict[str, int], shares: dict[str, float], repeats: dict[str, int], total: float | None = None) -> tuple[dict[str, float], float]:
    """The target shares themselves, and the largest total up to ``total`` that the repetition limits allow at them."""
    norm = sum(shares[s] for s in totals)
    weights = {s: shares[s] / norm for s in totals}
    most = most_tokens(totals, weights, repeats)
    return weights, most if total is None else min(total, most)


def choose(sized: DataFrame, key: str, source: str, budgets: dict[str, float], totals: dict[str, int], repeats: dict[str, int], documents: int, seed: int = 7) -> DataFrame:
    """(key, source, n_tokens, pass, repeats, block, ord): one row for each time a document is taken.

    Every pass orders a source's documents anew, by a hash of pass and key. A
    document's place in its pass, in tokens, is the sum of the hash ranges before
    its own and of the documents before it in the range; there are as many ranges as
    keep one to about BUCKET_ROWS documents, so no task holds a source. The last
    pass ends where the budget does, to the nearest document. Blocks are equal parts
    of each budget; ``ord`` orders the documents within a block, ties by key.
    ``repeats`` is how often the mix takes the document in all.
    """
    spark = sized.sparkSession
    rows = []
    for s, budget in budgets.items():
        full = min(int(budget / totals[s] + 1e-9), repeats[s])
        last = full if full == repeats[s] or budget - full * totals[s] < 0.5 else full + 1
        rows.append((s, last, float(budget), int(totals[s])))
    bits = max(1, min(30, math.ceil(math.log2(max(2, documents / BUCKET_ROWS)))))
    wanted = spark.createDataFrame(rows, "w_source string, passes int, budget double, own long")
    placed = (
        sized.join(F.broadcast(wanted), F.col(source) == F.col("w_source"))  # one row a source of the targets
        .filter("passes > 0 AND n_tokens > 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
        .withColumn("_h", F.xxhash64(F.lit(seed), F.col("pass"), F.col(key)))
        .withColumn("_b", F.shiftrightunsigned("_h", 64 - bits))
    )
    sums = placed.groupBy(F.col(source).alias("b_source"), F.col("pass").alias("b_pass"), F.col("_b").alias("b_b")).agg(F.sum("n_tokens").alias("n"))
    ahead = Window.partitionBy("b_source", "b_pass").orderBy("b_b").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("b_source", "b_pass", "b_b", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    inner = Window.partitionBy(source, "pass", "_b").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, 0)
    near = placed.withColumn("_upto", F.sum("n_tokens").over(inner))
    at = near.join(before, (F.col(source) == F.col("b_source")) & (F.col("pass") == F.col("b_pass")) & (F.col("_b") == F.col("b_b")))
    middle = (F.col("pass") - 1) * F.col("own") + F.col("before") + F.col("_upto") - F.col("n_tokens") / 2
    taken = at.withColumn("_at", middle).filter(F.col("_at") <= F.col("budget"))
    return taken.select(
        key,
        source,
        "n_tokens",
        "pass",
        F.count("*").over(Window.partitionBy(key)).cast("int").alias("repeats"),  # a key has at most max_repeats rows
        F.least(F.floor(F.col("_at") / F.col("budget") * BLOCKS), F.lit(BLOCKS - 1)).cast("int").alias("block"),
        F.xxhash64(F.lit(seed + 1), F.col("pass"), F.col(key)).alias("ord"),
    )


def mix(
    docs: DataFrame, targets: DataFrame, key: str, text: str, source: str, total: float | None = None, exact: bool = False, tokenizer: str = TOKENIZER
) -> tuple[DataFrame, DataFrame]:
    """Chosen documents (see ``choose``) and a report a source.

    ``targets``: source, target_share, max_repeats. With ``exact`` the weights are
    the target shares (``target_weights``), else those of one exponent with the
    entropy of the target shares (``temperature``). Documents whose source is null
    or has no target are not taken, nor are those without tokens; a source without
    documents, share or repeats leaves its share to the others, in proportion.
    ``total`` tokens are taken, or as many as the repetition limits allow, which is
    the default. Rows of ``targets`` that repeat a source count once, with their
    largest values. Empty tables give no documents.
    """
    spark = docs.sparkSession
    sized = stage(sizes(docs, key, text, source, tokenizer), "sizes")
    listed = targets.filter("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most"))
    own = sized.filter("n_tokens > 0").groupBy(F.col(source).alias("source")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("d"))
    stats = listed.join(own, "source", "left").collect()  # as many rows as targets
    usable = [r for r in stats if (r.n or 0) > 0 and (r.share or 0) > 0 and (r.most or 0) > 0]
    totals, repeats, shares = {r.source: int(r.n) for r in usable}, {r.source: int(r.most) for r in usable}, {r.source: float(r.share) for r in usable}
    exponent, weights, size = None, {}, 0.0
    if usable:
        wanted, _ = target_weights(totals, shares, repeats)
        if exact:
            weights, size = target_weights(totals, shares, repeats, total)
        else:
            exponent, weights, size = temperature(totals, repeats, entropy(wanted), total)
    chosen = choose(sized, key, source, {s: w * size for s, w in weights.items()}, totals, repeats, sum(r.d or 0 for r in stats))
    rows = [(r.source, r.share, exponent, weights.get(r.source, 0.0)) for r in stats]
    return chosen, share_report(chosen, spark.createDataFrame(rows, "source string, target_share double, exponent double, weight double"), source)


def share_report(chosen: DataFrame, weighted: DataFrame, source: str) -> DataFrame:
    """For each target: the exponent and weight aimed at, documents, tokens, most repeats, and the actual share with its distance from the target."""
    own = chosen.groupBy(F.col(source).alias("source")).agg(F.sum("n_tokens").alias("tokens"), F.count_if(F.col("pass") == 1).alias("n_docs"), F.max("repeats").alias("most_repeats"))
    everything = F.sum("tokens").over(Window.partitionBy())  # as many rows as targets
    actual = F.coalesce(F.col("tokens") / everything, F.lit(0.0))
    return weighted.join(own, "source", "left").select(
        "source",
        "target_share",
        F.round("exponent", 6).alias("exponent"),
        F.round("weight", 6).alias("weight"),
        F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.round(actual, 6).alias("actual_share"),
        F.round(actual - F.col("target_share"), 6).alias("off_target"),
    )
