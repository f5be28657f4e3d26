"""Free-text scores: ROUGE, embedding match, output length and completion."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from evalspark.functions import text, tokens as tok
from evalspark.operators.jsoneval import rate

# Tokens of one side that one task compares with as many of the other.
EMBEDDING_BLOCK = 512
# Keys over which one row's candidate blocks are dealt.
EMBEDDING_SPREAD = 16


def _f1(overlap: Column, candidate: Column, reference: Column) -> Column:
    """Harmonic mean of overlap/candidate and overlap/reference; 0 for no overlap."""
    return rate(2 * overlap, F.when(overlap > 0, candidate + reference))


def _stemmed(preds: DataFrame, use_stemmer: bool) -> DataFrame:
    """Both texts as token lists ``cand`` and ``ref``, stemmed or not."""
    tokenised = preds.withColumns(
        {
            "cand": tok.word_tokens(F.col("prediction")),
            "ref": tok.word_tokens(F.col("reference")),
        }
    )
    if not use_stemmer:
        return tokenised
    return tokenised.withColumns(
        {"cand": tok.stem_tokens(F.col("cand")), "ref": tok.stem_tokens(F.col("ref"))}
    )


def _overlap(n: int) -> Column:
    return tok.clipped_overlap(tok.ngrams(F.col("cand"), n), tok.ngrams(F.col("ref"), n))


def _rouge_n(n: int) -> Column:
    """F-measure of the n-gram overlap in column ``overlap{n}``."""

    def count(column: str) -> Column:
        return F.greatest(F.size(column) - (n - 1), F.lit(0))

    return _f1(F.col(f"overlap{n}"), count("cand"), count("ref"))


def _rouge_l() -> Column:
    return _f1(F.col("lcs"), F.size("cand"), F.size("ref"))


def rouge_n(preds: DataFrame, n: int, use_stemmer: bool = True) -> DataFrame:
    """Add ``rouge{n}_f1``: clipped n-gram overlap as an F-measure, row by row."""
    counted = _stemmed(preds, use_stemmer).withColumn(f"overlap{n}", _overlap(n))
    return counted.select(*preds.columns, _rouge_n(n).alias(f"rouge{n}_f1"))


def rouge_l(preds: DataFrame, use_stemmer: bool = True) -> DataFrame:
    """Add ``rougeL_f1``: longest common subsequence as an F-measure, row by row."""
    lcs = tok.lcs_length(F.col("cand"), F.col("ref"))
    counted = _stemmed(preds, use_stemmer).withColumn("lcs", lcs)
    return counted.select(*preds.columns, _rouge_l().alias("rougeL_f1"))


def rouge(preds: DataFrame, use_stemmer: bool = True) -> DataFrame:
    """All three ROUGE scores of each row, from one tokenisation of both texts."""
    lcs = tok.lcs_length(F.col("cand"), F.col("ref"))
    counted = _stemmed(preds, use_stemmer).withColumns(
        {"overlap1": _overlap(1), "overlap2": _overlap(2), "lcs": lcs}
    )
    return counted.select(
        *preds.columns,
        _rouge_n(1).alias("rouge1_f1"),
        _rouge_n(2).alias("rouge2_f1"),
        _rouge_l().alias("rougeL_f1"),
    )


# A pattern whose matches are tokens, or a function from a text to its list of tokens.
Tokenizer = str | Callable[[Column], Column]


def output_length(preds: DataFrame, tokenizer: Tokenizer = r"\S+") -> DataFrame:
    """Mean number of tokens per output and checkpoint."""
    return preds.groupBy("checkpoint").agg(
        F.avg(F.size(text.tokens(F.col("prediction"), tokenizer))).alias("avg_output_tokens")
    )


def completion_rate(preds: DataFrame, min_chars: int = 20) -> DataFrame:
    """Share of outputs per checkpoint that count as completed."""
    done = text.task_completed(F.col("prediction"), min_chars)
    return preds.groupBy("checkpoint").agg(
        F.avg(done.cast("double")).alias("task_completion_rate")
    )


# --- embedding match ----------------------------------------------------------

_BEST = T.StructType(
    [
        T.StructField("cand_best", T.ArrayType(T.DoubleType())),
        T.StructField("ref_best", T.ArrayType(T.DoubleType())),
    ]
)


def _matrix(vectors: pa.ListScalar) -> np.ndarray:
    rows = vectors.values
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _lists(sizes: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), values)


def _numbers(arrays: list[np.ndarray]) -> pa.Array:
    """All numbers one behind the other, without making objects of them."""
    return pa.array(np.concatenate([np.zeros(0), *(a.ravel() for a in arrays)]))


@F.arrow_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def _unit(vectors: pa.Array) -> pa.Array:
    """Blocks of vectors of length one; zero vectors stay."""
    blocks = []
    for block in vectors:
        m = _matrix(block)
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        blocks.append(m / np.where(norm == 0.0, 1.0, norm))
    rows = _lists([n for m in blocks for n in [m.shape[1]] * len(m)], _numbers(blocks))
    return _lists([len(m) for m in blocks], rows)


@F.arrow_udf(_BEST)
def _best_matches(candidate: pa.Array, reference: pa.Array) -> pa.Array:
    """Per token, the best cosine with any token of the other block of unit vectors."""
    best = ([], [])
    for c, r in zip(candidate, reference):
        cosines = _matrix(c) @ _matrix(r).T
        best[0].append(cosines.max(axis=1))
        best[1].append(cosines.max(axis=0))
    return pa.StructArray.from_arrays(
        [_lists([len(x) for x in side], _numbers(side)) for side in best], ["cand_best", "ref_best"]
    )


def _blocks(vectors: DataFrame, side: str, name: str, block: int) -> DataFrame:
    """Runs of ``block`` neighbouring tokens of one side as lists of unit vectors."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "vector")))
    gathered = (
        vectors.filter(F.col("side") == side)
        .groupBy("checkpoint", "row_id", F.floor(F.col("pos") / block).alias(f"{name}_block"))
        .agg(F.transform(ordered, lambda x: x["vector"]).alias(name))
    )
    return gathered.withColumn(name, _unit(F.col(name)))


def embedding_f1(
    token_embeddings: DataFrame, block: int = EMBEDDING_BLOCK, spread: int = EMBEDDING_SPREAD
) -> DataFrame:
    """Precision, recall and F1 per row from the best match of every token.

    Input: checkpoint, row_id, side (candidate or reference), pos, vector. Texts
    meet in blocks of at most ``block`` tokens. A row's candidate blocks are dealt over up to
    ``spread`` keys and its reference blocks sent to each of them, so a long text is matched in
    several tasks. A row with one empty side scores 0.
    """
    row = ["checkpoint", "row_id"]
    cand = _blocks(token_embeddings, "candidate", "cand", block)
    ref = _blocks(token_embeddings, "reference", "ref", block)
    number = F.floor(F.col("pos") / block)
    sizes = token_embeddings.groupBy(*row).agg(
        F.max(F.when(F.col("side") == "candidate", number)).alias("_last"),
        F.count_if(F.col("side") == "reference").alias("_refs"),
    )
    keys = F.sequence(F.lit(0), F.least(F.col("_last"), F.lit(spread - 1)).cast("int"))
    dealt = ref.join(sizes.filter("_last IS NOT NULL"), row).select(
        *row, "ref_block", "ref", F.explode(keys).alias("_key")
    )
    met = (
        cand.withColumn("_key", (F.col("cand_block") % spread).cast("int"))
        .join(dealt, [*row, "_key"])
        .withColumn("best", _best_matches(F.col("cand"), F.col("ref")))
    )
    # A block meets every block of the other side: take the best over them first.
    per_token = (
        met.select(
            *row,
            F.inline(
                F.array(
                    F.struct(
                        F.lit("candidate").alias("side"),
                        F.col("cand_block").alias("block_no"),
                        F.col("best.cand_best").alias("values"),
                    ),
                    F.struct(
                        F.lit("reference").alias("side"),
                        F.col("ref_block").alias("block_no"),
                        F.col("best.ref_best").alias("values"),
                    ),
                )
            ),
        )
        .select(*row, "side", "block_no", F.posexplode("values").alias("place", "best"))
        .groupBy(*row, "side", "block_no", "place")
        .agg(F.max("best").alias("best"))
    )

    def mean(side: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col("side") == side, F.col("best"))), F.lit(0.0))

    p, r = F.col("precision"), F.col("recall")
    scored = per_token.groupBy(*row).agg(
        mean("candidate").alias("precision"), mean("reference").alias("recall")
    )
    zero = F.lit(0.0)
    alone = sizes.filter("_last IS NULL OR _refs = 0").select(
        *row, zero.alias("precision"), zero.alias("recall")
    )
    return scored.unionByName(alone).withColumn("f1", rate(2 * p * r, F.when(p + r != 0, p + r)))


def embedding_f1_means(scored: DataFrame) -> DataFrame:
    """Mean embedding F1 per checkpoint."""
    return scored.groupBy("checkpoint").agg(F.avg("f1").alias("bertscore_f1_avg"))


def text_metrics(
    preds: DataFrame,
    token_embeddings: DataFrame | None = None,
    tokenizer: Tokenizer = r"\S+",
    min_chars: int = 20,
    use_stemmer: bool = True,
) -> DataFrame:
    """All text scores per checkpoint; checkpoints without rows have none.

    Rows are scored where they are and only per-checkpoint sums are shuffled.
    """
    table = text_metrics_of(text_sums(preds, tokenizer, min_chars, use_stemmer))
    if token_embeddings is None:
        return table.withColumn("bertscore_f1_avg", F.lit(None).cast("double"))
    return table.join(embedding_f1_means(embedding_f1(token_embeddings)), "checkpoint", "left")


_TEXT_SCORES = ("rouge1_f1", "rouge2_f1", "rougeL_f1")


def text_sums(
    preds: DataFrame,
    tokenizer: Tokenizer = r"\S+",
    min_chars: int = 20,
    use_stemmer: bool = True,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """What the text metrics are made of, per checkpoint and the columns ``by``, as sums to be added up."""
    prediction = F.col("prediction")
    measured = rouge(preds, use_stemmer).select(
        *by,
        "checkpoint",
        F.size(text.tokens(prediction, tokenizer)).alias("n_tokens"),
        text.task_completed(prediction, min_chars).alias("completed"),
        *_TEXT_SCORES,
    )
    return measured.groupBy(*by, "checkpoint").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("n_tokens").alias("n_tokens"),
        F.count_if("completed").alias("completed"),
        *(F.sum(c).alias(c) for c in _TEXT_SCORES),
    )


def add_text_sums(sums: DataFrame) -> DataFrame:
    """``text_sums`` of parts of the rows as those of all of them, per checkpoint."""
    numbers = ("samples", "n_tokens", "completed", *_TEXT_SCORES)
    return sums.groupBy("checkpoint").agg(*(F.sum(c).alias(c) for c in numbers))


def text_metrics_of(sums: DataFrame) -> DataFrame:
    """Means per checkpoint, from its sums; without embedding F1."""
    samples = F.col("samples")
    return sums.select(
        "checkpoint",
        "samples",
        rate(F.col("n_tokens"), samples).alias("avg_output_tokens"),
        rate(F.col("completed"), samples).alias("task_completion_rate"),
        *(rate(F.col(c), samples).alias(c) for c in _TEXT_SCORES),
    )
