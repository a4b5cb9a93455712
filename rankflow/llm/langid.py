"""Language identification with unigram pieces, marginalised over segmentations.

Per language, pieces of a fixed public vocabulary get probabilities from their counts in all
training texts. A word's likelihood is the sum over all its segmentations into pieces, found by the forward
algorithm; a text's is the product over its words. Words are runs of letters in lower case.

Defined results: a text that is null or has no letter is ``und`` with score 0. Without training
rows every text is. Rows without a language are not learned from. Equal texts get equal results; ties
go to the first language in code point order. Every word of a text counts, however long the text.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.llm.lattice import SPACE_SIGN, TOKENIZER_PATH, blocks, load_vocabulary, log_marginals

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
SMOOTHING = 0.1
# Memory of a task: words held at once, and words whose likelihoods are remembered.
WORDS_HELD = 50_000
LONG_TEXT = 500_000
WORDS_KNOWN = 200_000


def words_of(text: str) -> Iterator[list[str]]:
    """The text's words, a bounded number at a time."""
    text = text.lower()
    if len(text) <= LONG_TEXT:
        if found := LETTERS.findall(text):
            yield found
        return
    found = LETTERS.finditer(text)
    while held := [m[0] for m in itertools.islice(found, WORDS_HELD)]:
        yield held


@dataclass(frozen=True)
class LanguageModel:
    """``probabilities`` has a row per piece and one for unknown characters, a column per language."""

    languages: list[str]
    probabilities: np.ndarray
    log_prior: np.ndarray
    tokenizer: str


def piece_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(lang, piece, n)`` over whole texts ``(lang, text)``; piece -1 counts texts.

    Words are counted per task first, so each is encoded once per task and flush.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer, add_bos=False)
        words: dict[str, Counter] = {}
        texts: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in words.items():
                pieces: Counter = Counter()
                items = list(counter.items())
                encoded = model.encode([w for w, _ in items], num_threads=1)
                for (_, n), ids in zip(items, encoded):
                    for i in ids:
                        pieces[i] += n
                pieces[-1] = texts.pop(lang, 0)
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang] * len(pieces), "piece": list(pieces.keys()), "n": list(pieces.values()),
                })
            words.clear()

        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                counter = words.setdefault(lang, Counter())
                before = len(counter)
                texts[lang] += 1
                for some in words_of(text):
                    counter.update(some)
                held += len(counter) - before
                if held > WORDS_KNOWN:
                    yield from flush()
                    held = 0
        yield from flush()

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, piece bigint, n bigint")
    return counted.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", tokenizer: str = TOKENIZER_PATH
) -> LanguageModel:
    """Learns from every row with a language; what reaches the driver is languages x vocabulary."""
    known = picked(docs, lang=lang_col, text=text_col).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = piece_counts(known, tokenizer).toPandas()
    languages = sorted(counts["lang"].unique(), key=str.encode)
    size = load_vocabulary(tokenizer).size
    table, prior = np.zeros((size + 1, len(languages))), np.zeros(len(languages))
    for column, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        prior[column] = own.loc[own["piece"] < 0, "n"].sum() + 1.0
        pieces = own[own["piece"] >= 0]
        table[pieces["piece"].to_numpy(), column] = pieces["n"].to_numpy()
    table += SMOOTHING
    table /= table.sum(axis=0, keepdims=True)
    return LanguageModel(list(languages), table, np.log(prior / max(prior.sum(), 1.0)), tokenizer)


def predictor(spark: SparkSession, model: LanguageModel):
    """A column function from text to ``struct<lang, score>``; the score is the posterior."""
    if not model.languages:
        nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
        return lambda text: nothing
    # Plain values: a worker may read them before it can import this package.
    shared = spark.sparkContext.broadcast(
        (model.languages, model.probabilities, model.log_prior, model.tokenizer)
    )

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, probabilities, log_prior, tokenizer = shared.value
        vocabulary = load_vocabulary(tokenizer)
        places: dict[str, int] = {}
        values = np.zeros((WORDS_KNOWN, len(languages)))

        def learn(words: set[str]) -> None:
            """Remembers the words' likelihoods, forgetting all others where room runs out."""
            nonlocal values
            fresh = [w for w in words if w not in places]
            if len(places) + len(fresh) > len(values):
                places.clear()
                fresh = list(words)
                if len(fresh) > len(values):
                    values = np.zeros((len(fresh), len(languages)))
            if fresh:
                low = len(places)
                values[low : low + len(fresh)] = log_marginals(vocabulary, [SPACE_SIGN + w for w in fresh], probabilities)
                places.update(zip(fresh, range(low, low + len(fresh))))

        def total_of(words: list[str]) -> np.ndarray:
            return values[np.fromiter(map(places.__getitem__, words), np.int64, len(words))].sum(axis=0)

        for batch in batches:
            langs, scores = [], []
            for group in blocks(batch, lambda t: len(t or "") + 1, LONG_TEXT):
                # Words of several short texts are scored together, a long text part by part.
                totals = []
                if len(group) == 1:
                    total, any_word = log_prior.copy(), False
                    for part in words_of(group[0] or ""):
                        learn(set(part))
                        total += total_of(part)
                        any_word = True
                    totals.append(total if any_word else None)
                else:
                    split = [[w for part in words_of(t or "") for w in part] for t in group]
                    learn(set().union(*split))
                    totals += [log_prior + total_of(words) if words else None for words in split]
                for total in totals:
                    best = 0 if total is None else int(total.argmax())
                    langs.append(UNDETERMINED if total is None else languages[best])
                    scores.append(0.0 if total is None else float(1.0 / np.exp(total - total[best]).sum()))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return predict


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out`` of the predicted language and its posterior."""
    predict = predictor(docs.sparkSession, model)
    text: Column = F.col(f"`{text_col}`")
    # A text without a letter never reaches the model.
    lettered = F.when(text.rlike(r"\p{L}"), text)
    return docs.withColumn(out, predict(lettered))
