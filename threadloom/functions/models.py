"""Registry of user-supplied models and their deterministic offline stand-ins.

Every model is called from an Arrow-batched pandas UDF or ``mapInPandas``, is
built once per Python worker, and is retried a bounded number of times. A batch
that still fails is halved until the failing rows stand alone; they are reported
in an error column instead of being dropped, and all others keep their results.
"""

from __future__ import annotations

import hashlib
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadloom import schemas
from threadloom.functions import text as tx
from threadloom.functions.tokens import let

# Attempts at a model call.
ATTEMPTS = 10
PAUSE_SECONDS = 3.0
# Characters of the texts whose words one task counts.
COUNTED_CHARACTERS = 16 << 20


def with_retries(call: Callable, attempts: int = ATTEMPTS, pause: float = PAUSE_SECONDS) -> Callable:
    """Wrap a model call: (result, None) or (None, error text) after the last try."""

    def wrapped(*args):
        error = ""
        for attempt in range(attempts):
            try:
                return call(*args), None
            except Exception as exc:  # model calls may raise anything
                error = f"{type(exc).__name__}: {exc}"
                if attempt + 1 < attempts:
                    time.sleep(pause)
        return None, error

    return wrapped


def isolated(call: Callable[[list], Sequence], attempts: int = ATTEMPTS, pause: float = PAUSE_SECONDS) -> Callable:
    """Batch call as (results, errors) per row: a failing row costs no other row its result.

    A batch that fails to the last attempt is halved until the failing rows
    stand alone; these get all attempts again, halves between get one.
    """

    def checked(rows: list) -> list:
        result = list(call(rows))
        if len(result) != len(rows):
            raise ValueError(f"{len(result)} results for {len(rows)} rows")
        return result

    patient, once = with_retries(checked, attempts, pause), with_retries(checked, 1, 0.0)

    def run(rows: list, first: bool = True) -> tuple[list, list]:
        if not rows:
            return [], []
        result, error = (patient if first or len(rows) == 1 else once)(rows)
        if error is None:
            return result, [None] * len(rows)
        if len(rows) == 1:
            return [None], [error]
        middle = len(rows) // 2
        left, right = run(rows[:middle], False), run(rows[middle:], False)
        return left[0] + right[0], left[1] + right[1]

    return run


def in_batches(call: Callable[[list], tuple[list, list]], rows: list, batch_size: int) -> tuple[list, list]:
    results, errors = [], []
    for start in range(0, len(rows), batch_size):
        found, failed = call(rows[start : start + batch_size])
        results += found
        errors += failed
    return results, errors


# --- encoder ---------------------------------------------------------------


def hashing_encoder(dim: int = 64) -> Callable[[Sequence[str]], dict]:
    """Stand-in encoder: signed feature hashing, and word counts as weights."""

    def encode(texts: Sequence[str]) -> dict:
        dense = np.zeros((len(texts), dim))
        lexical = []
        for row, text in enumerate(texts):
            counts = Counter(t for t in text.lower().split(" ") if t)
            for term, n in counts.items():
                digest = hashlib.md5(term.encode()).digest()
                slot = int.from_bytes(digest[:4], "little") % dim
                dense[row, slot] += n if digest[4] & 1 else -n
            lexical.append({t: float(n) for t, n in counts.items()})
        lengths = np.linalg.norm(dense, axis=1, keepdims=True)
        dense = np.divide(dense, lengths, out=np.zeros_like(dense), where=lengths > 0)
        return {"dense_vecs": dense, "lexical_weights": lexical}

    return encode


def encode_column(
    text: Column,
    make_encoder: Callable[[], Callable] = hashing_encoder,
    batch_size: int = 64,
    attempts: int = ATTEMPTS,
    pause: float = PAUSE_SECONDS,
) -> Column:
    """struct(dense, lexical, error) of each text; the model is made once per worker."""

    @F.pandas_udf("struct<dense: array<float>, lexical: map<string, double>, error: string>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_encoder()

        def by_row(texts: list) -> list:
            found = model(texts)
            return [(np.asarray(v, dtype=np.float32), dict(w)) for v, w in zip(found["dense_vecs"], found["lexical_weights"])]

        call = isolated(by_row, attempts, pause)
        for texts in batches:
            found, errors = in_batches(call, texts.fillna("").tolist(), batch_size)
            yield pd.DataFrame(
                {"dense": [f and f[0] for f in found], "lexical": [f and f[1] for f in found], "error": errors}
            )

    return encode(text)


def lexical_weights(text: Column) -> Column:
    """Word-count weights of the lower-cased text, counted as run lengths of the sorted words."""
    words = F.sort_array(tx.words(F.coalesce(F.lower(text), F.lit(""))))

    def counted(sorted_words: Column) -> Column:
        return let(
            lambda v: F.map_from_arrays(
                F.transform(v["starts"], lambda i: F.get(v["words"], i)),
                F.zip_with(
                    v["starts"],
                    F.concat(F.slice(v["starts"], 2, F.size(v["words"]) + 1), F.array(F.size(v["words"]))),
                    lambda a, b: (b - a).cast("double"),
                ),
            ),
            words=sorted_words,
            starts=F.filter(
                F.sequence(F.lit(0), F.size(sorted_words) - 1),
                lambda i: (i == 0) | (F.get(sorted_words, i) != F.get(sorted_words, i - 1)),
            ),
        )

    empty = F.create_map().cast("map<string,double>")
    return let(lambda h: F.when(F.size(h["w"]) > 0, counted(h["w"])).otherwise(empty), w=words)


def lexical_rows(df: DataFrame, key: str, text: str, names: tuple[str, str, str]) -> DataFrame:
    """The same weights as rows (key, term, weight), without a map per row in between.

    Texts move by their key, not their words; a task counts those of at most some ``COUNTED_CHARACTERS``.
    """
    key_name, term, weight = names
    characters = df.agg(F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0))).first()[0]
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-characters // COUNTED_CHARACTERS))
    said = df.select(key, text).repartition(tasks, key).select(F.col(key).alias(key_name), F.explode(F.split(F.lower(text), " ", -1)).alias(term)).where(F.col(term) != "")
    return said.groupBy(key_name, term).agg(F.count(F.lit(1)).cast("double").alias(weight))


# --- tokenizer ---------------------------------------------------------------


def word_ids(text: Column, vocabulary_bits: int = 60) -> Column:
    """Stand-in tokenizer: words between spaces, each hashed to a stable id."""
    digits = vocabulary_bits // 4
    return F.transform(
        tx.words(text),
        lambda t: F.conv(F.substring(F.md5(t), 1, digits), 16, 10).cast("bigint"),
    )


def token_count(text: Column) -> Column:
    return F.size(tx.words(text)).cast("bigint")


def tokenizer_udf(make_tokenizer: Callable[[], Callable[[str], Sequence[int]]]) -> Callable[[Column], Column]:
    """Column function of a caller's tokenizer (text -> ids)."""

    @F.pandas_udf("array<bigint>")
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_tokenizer()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else [int(i) for i in encode(t)])

    return tokenize


def list_tokenizer_udf(make_tokenizer: Callable[[], Callable[[str], Sequence[int]]]) -> Callable[[Column], Column]:
    """Column function of a caller's tokenizer for arrays of texts."""

    @F.pandas_udf("array<array<bigint>>")
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_tokenizer()
        for lists in batches:
            yield lists.map(
                lambda texts: None if texts is None else [[int(i) for i in encode(t)] for t in texts]
            )

    return tokenize


def joint_answer_tokens(
    make_tokenizer: Callable[[], Callable[[str], Sequence[int]]],
) -> Callable[[Column, Column], Column]:
    """struct(prompt_ids, answer_ids) from tokenising prompt and answer together.

    When the border merges into one token, the boundary moves one token left.
    """

    @F.pandas_udf("struct<prompt_ids: array<bigint>, answer_ids: array<bigint>>")
    def split(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encode = make_tokenizer()
        for prompts, answers in batches:
            left, right = [], []
            for prompt, answer in zip(prompts, answers):
                alone = list(encode(prompt))
                whole = list(encode(prompt + answer))
                if len(whole) < len(alone):
                    raise ValueError("prompt and answer together have fewer tokens than the prompt")
                cut = len(alone) if whole[: len(alone)] == alone else len(alone) - 1
                left.append(whole[:cut])
                right.append(whole[cut:])
            yield pd.DataFrame({"prompt_ids": left, "answer_ids": right})

    return split


# --- pair scorer, generator, judge, rewards -----------------------------------


def pair_scorer(
    make_scorer: Callable[[], Callable], batch_size: int = 64, attempts: int = ATTEMPTS, pause: float = PAUSE_SECONDS
) -> Callable[[Column, Column], Column]:
    """Column function of a caller's model scoring (question, candidate) pairs; NULL where it fails."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        call = isolated(make_scorer(), attempts, pause)
        for left, right in batches:
            found, _ = in_batches(call, [list(p) for p in zip(left, right)], batch_size)
            yield pd.Series(found, dtype="float64")

    return score


def generate_by(
    df: DataFrame,
    prompt: str,
    model: str,
    makers: dict[str, Callable[[], Callable[[list], list]]],
    out: str = "generated",
    batch_size: int = 64,
    attempts: int = ATTEMPTS,
    pause: float = PAUSE_SECONDS,
) -> DataFrame:
    """Append the answer of the model that each row names, and the error of failed calls.

    Only prompt and model name cross into Python; a model is made once per
    worker and only if a row names it.
    """

    @F.pandas_udf("struct<answer: string, error: string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        calls: dict[str, Callable] = {}
        for prompts, names in batches:
            answers = pd.DataFrame({"answer": [None] * len(prompts), "error": [None] * len(prompts)}, dtype=object)
            for name in names.unique():
                if name not in calls:
                    calls[name] = isolated(makers[name](), attempts, pause)
                at = np.flatnonzero((names == name).to_numpy())
                found, errors = in_batches(calls[name], prompts.iloc[at].tolist(), batch_size)
                answers.iloc[at, 0], answers.iloc[at, 1] = found, errors
            yield answers

    return (
        df.withColumn("_g", run(F.col(prompt), F.col(model)))
        .withColumns({out: F.col("_g.answer"), f"{out}_error": F.col("_g.error")})
        .drop("_g")
    )


def generate(
    df: DataFrame, prompt: str, make_generator: Callable[[], Callable[[list], list]], out: str = "generated", **calls
) -> DataFrame:
    """Append one model's answer to each prompt, and the error of failed calls."""
    named = df.withColumn("_model", F.lit(""))
    return generate_by(named, prompt, "_model", {"": make_generator}, out, **calls).drop("_model")


def echo_generator(prefix: str = "echo: ", limit: int | None = None) -> Callable[[], Callable]:
    """Stand-in generator: repeats the prompt."""
    return lambda: (lambda prompts: [prefix + (p if limit is None else p[:limit]) for p in prompts])


def judge_pairs(
    make_judge: Callable[[], Callable],
) -> Callable[[Column, Column, Column], Column]:
    """Column function of a judge: index of the better of two completions."""

    @F.pandas_udf("int")
    def rank(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = make_judge()
        for prompts, first, second in batches:
            pairs = [list(p) for p in zip(first, second)]
            yield pd.Series(model(prompts.tolist(), pairs), dtype="int32")

    return rank


def longer_is_better() -> Callable:
    """Stand-in judge: 0 when the first completion is at least as long."""
    return lambda prompts, pairs: [0 if len(a) >= len(b) else 1 for a, b in pairs]


def reward_table(
    df: DataFrame, rewards: dict[str, Callable[..., Column]], keys: Sequence[str], **columns: Column
) -> DataFrame:
    """Long (keys, reward_name, reward): every function gets the columns by name."""
    entries = [
        F.struct(F.lit(name).alias("reward_name"), fn(**columns).cast("double").alias("reward"))
        for name, fn in rewards.items()
    ]
    return df.select(*keys, F.inline(F.array(*entries)))
