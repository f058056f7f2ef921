"""Mixing sources to target shares of tokens, small sources being repeated up to a cap.

A source's documents should occur so many times on average that its tokens make up its share of the mixture. The whole
part of that number is given to each document; the fractional part is a probability, and dependent rounding makes it 0
or 1: of two undecided documents, token mass is moved from one to the other, in a direction drawn so that neither
expectation changes, until one of them is decided. The mass that a source shall have is kept at every step, so its
tokens end within one document of the target, whatever is drawn. To make that a short one, the longest documents are
paired among themselves first, and the one left is decided against all shorter ones together, which have one probability
still; then the same with these.

Undecided documents are paired off inside chunks of bounded size; each chunk leaves at most one, and what chunks leave
is paired off again, a level of a tree at a time. A source of any size thus never meets in one task.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import bounded, kept, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE of this vocabulary cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents of a chunk, and chunks whose remainders meet on the next level.
CHUNK_ROWS, FAN = 20_000, 1_000


def plain_source(c: Column | str) -> Column:
    """Lower case, without blanks around it, '_' for each of '-', '_' and blank. Null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.btrim(F.lower(c)), "[-_ ]", "_")


@lru_cache(maxsize=2)
def _encoding(path: str):  # noqa: ANN202
    import tiktoken

    if not os.path.exists(path):  # an executor without the vocabulary takes the one that token_counts() sent along
        path = SparkFiles.get(os.path.basename(path))
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        for batch in batches:
            text = batch.column(2)
            tokens = pa.array([len(encode(t.as_py())) if t.is_valid else 0 for t in text], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), tokens], ["doc_id", "source", "tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens): tokens of the whole text; 0 for null and empty texts. source is plain_source().

    tokenizer: the vocabulary's path on the driver, which sends it to executors, or on each executor.
    """
    context = docs.sparkSession.sparkContext
    if not context.master.startswith("local") and os.path.exists(tokenizer):
        context.addFile(tokenizer)
    slim = spread(docs.select("doc_id", plain_source("source").alias("source"), F.col("text").cast("string").alias("text")))
    return slim.mapInArrow(_counter(tokenizer), f"doc_id {dict(slim.dtypes)['doc_id']}, source string, tokens bigint")


def paired_off(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Probabilities p after moving mass p * size between undecided entries until at most one is undecided."""
    p = p.astype(float).copy()
    left = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if left < 0:
            left = i
            continue
        a, b = left, i
        up = min((1.0 - p[a]) * size[a], p[b] * size[b])  # mass that may go from b to a
        down = min(p[a] * size[a], (1.0 - p[b]) * size[b])
        move = up if draw.random() * (up + down) < down else -down
        for k, m in ((a, move), (b, -move)):
            p[k] += m / size[k]
            if p[k] < 1e-12 or p[k] > 1.0 - 1e-12:
                p[k] = round(p[k])
        open_ = [k for k in (a, b) if 0.0 < p[k] < 1.0]
        left = open_[0] if open_ else -1
    return p


#: Documents that are paired to the end without a pool of shorter ones behind them, and the part of the open documents
#: that is paired off at a time.
RESERVE, SHARE = 8, 16


def settled(p: float, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Documents of falling size, all of probability p, until at most one is undecided: one of the shortest RESERVE, unless
    a document outweighs what all that are shorter may give or take.

    The longest, a part in SHARE, are paired off. The one left then trades with the pool of all shorter documents: it
    becomes 1 with its own probability, else 0, and the pool's common probability falls or rises by the mass that this
    takes, so that no expectation changes. Where the pool can't, it is paired on with the next part.
    """
    out, n, at, left = np.full(len(size), float(p)), len(size), 0, []
    while at < n:
        end = at + -(-(n - at) // SHARE) if n - at > RESERVE else n
        out[at:end] = p
        members = np.array([*left, *range(at, end)])
        out[members] = paired_off(out[members], size[members], draw)
        left, at = [k for k in members.tolist() if 0.0 < out[k] < 1.0], end
        pool = float(size[at:].sum())
        if not left or not 0.0 < p < 1.0:
            continue
        k = left[0]
        taken, given = (1.0 - out[k]) * size[k], out[k] * size[k]
        if taken <= p * pool and given <= (1.0 - p) * pool and pool:
            one = draw.random() < out[k]
            out[k], p, left = float(one), p - taken / pool if one else p + given / pool, []
            if p < 1e-12 or p > 1.0 - 1e-12:
                p = float(round(p))
    return out


_LEVEL = "source string, node bigint, place bigint, tokens bigint, p double"


def _reducer(seed: int, level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        # From the longest down: long documents are decided while there is mass left to trade, what remains is short.
        table = table.sort_by([("tokens", "descending"), ("place", "ascending")])
        source, node = table["source"][0].as_py(), table["node"][0].as_py()
        draw = np.random.default_rng([seed, level, node, *source.encode()])
        p, size = table["p"].to_numpy(), table["tokens"].to_numpy()
        # All of a source begin with one probability; what chunks have left over has several.
        p = settled(p[0], size, draw) if level == 0 else paired_off(p, size, draw)
        if last:
            p = np.where((p > 0) & (p < 1), draw.random(len(p)) < p, p)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return run


def plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """Per listed source: source, target_share, max_repeats, documents, available (tokens), copies (mean per token).

    total is the size wanted in tokens; without it, the largest for which every source that has tokens can hold its
    share. A source that can't reach its part of a given total is repeated max_repeats times, no more. Listed sources
    without tokens get no copies, and the others' shares are then in proportion. Sources that aren't listed, or with a
    share that is null or not above 0, aren't part of the mixture. A null max_repeats counts as 1.
    """
    wanted = targets.select(plain_source("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
    wanted = wanted.where("target_share > 0 AND max_repeats > 0").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    had = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("available"))
    both = wanted.join(had, "source", "left").fillna(0, ["documents", "available"])
    if total is None:
        total = both.where("available > 0").agg(F.min(F.col("max_repeats") * F.col("available") / F.col("target_share"))).first()[0] or 0.0
    copies = F.when(F.col("available") > 0, F.least(F.col("max_repeats").cast("double"), F.lit(float(total)) * F.col("target_share") / F.col("available"))).otherwise(0.0)
    # A mean that is whole but for rounding of the arithmetic is whole.
    return both.withColumn("copies", F.when(F.abs(copies - F.round(copies)) < 1e-9, F.round(copies)).otherwise(copies))


def mixture(sizes: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(chosen documents: doc_id, source, tokens, copies; report per listed source).

    sizes has doc_id, source, tokens, as from token_counts(). A document with 0 tokens isn't chosen. Rows with the same
    doc_id are documents of their own. The report gives documents, available, target_share, max_repeats, copies (the
    mean aimed at), chosen (documents), tokens (copies counted) and actual_share of all tokens of the mixture. The same
    data and seed give the same mixture however the data are spread over files and tasks.
    """
    sizes = kept(sizes, "sizes")
    planned = kept(plan(sizes, targets, total), "plan")
    docs = sizes.where("tokens > 0").join(bounded(planned.select("source", "copies", "documents")), "source")
    docs = docs.withColumn("base", F.floor("copies")).withColumn("place", F.xxhash64("doc_id", F.lit(seed)))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("documents") / CHUNK_ROWS))
    open_ = docs.where("copies > base").select("source", F.pmod("place", chunks).alias("node"), "place", "tokens", (F.col("copies") - F.col("base")).alias("p"))
    most = planned.agg(F.max("documents")).first()[0] or 0
    nodes, level, decided = max(1, -(-most // CHUNK_ROWS)), 0, None
    while True:
        last = nodes == 1
        done = kept(open_.groupBy("source", "node").applyInArrow(_reducer(seed, level, last), _LEVEL), "level")
        ready = done.where("p = 0 OR p = 1").select("source", "place", "tokens", "p")
        decided = ready if decided is None else decided.unionByName(ready)
        if last:
            break
        open_ = done.where("p > 0 AND p < 1").withColumn("node", F.floor(F.col("node") / FAN))
        nodes, level = -(-nodes // FAN), level + 1
    # Documents equal in source, place and tokens are alike here; the n-th of them takes the n-th decision.
    extra = decided.groupBy("source", "place", "tokens").agg(F.sum("p").cast("bigint").alias("ones"))
    same = ["source", "place", "tokens"]
    joined = docs.join(extra, same, "left").withColumn("ones", F.coalesce("ones", F.lit(0)))
    nth = F.row_number().over(_alike(same))
    chosen = kept(joined.withColumn("copies", F.col("base") + F.when(nth <= F.col("ones"), 1).otherwise(0)).where("copies > 0").select("doc_id", "source", "tokens", "copies"), "chosen")
    got = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("chosen"), F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.max("copies").alias("most_copies"))
    whole = got.agg(F.sum("used")).first()[0] or 0
    report = planned.join(got, "source", "left").fillna(0, ["chosen", "used", "most_copies"])
    share = F.col("used") / F.lit(float(whole)) if whole else F.lit(0.0)
    return chosen, report.select("source", "target_share", share.alias("actual_share"), "max_repeats", "most_copies", "documents", "chosen", "available", F.col("used").alias("tokens"), F.col("copies").alias("mean_copies"))


def _alike(columns: list[str]):  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy(*columns).orderBy("doc_id")
