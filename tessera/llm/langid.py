"""Operator 7: language identification, by known words first and by ever shorter letter sequences for others.

The model has, for each language, the log frequency of known words, and of sequences of 4, 3, 2
and 1 letters within words (with marks for begin and end). A known word scores its log frequency
in each language. An unseen word is walked letter by letter: at each place the longest known
sequence of up to 4 that begins there scores, and the word scores the mean (over places with 4
letters ahead; a shorter word is one place).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_map, runs, written

UNKNOWN = "und"
#: Longest letter sequence.
ORDER = 4
#: What may stand around a word; such a piece needs no search for words.
_AROUND = ".,;:!?*#%&$()[]{}\"'-_/+=0123456789"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-case words of letters."""
    return [x for x in _WORD.findall(text.lower()) if x.isalpha() or any(map(str.isalpha, x))]


def sequences(word: str) -> Iterator[tuple[int, str]]:
    marked = f"^{word}$"
    for n in range(1, ORDER + 1):
        for i in range(len(marked) - n + 1):
            yield n, marked[i : i + n]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, then of their sequences: a word is taken apart once for all the times that it occurs."""
    words: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        counts: Counter = Counter()
        for lang, own in words.items():
            for word, k in own.items():
                counts[lang, 0, word] = k
                for n, gram in sequences(word):
                    counts[lang, n, gram] += k
        lang, order, gram = zip(*counts)
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(order, pa.int32()), pa.array(gram, pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "n", "gram", "count"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, words.values())) > 50_000:
            yield out()
            words.clear()
    if any(words.values()):
        yield out()


class Model:
    """Of each language: log frequencies of words (n = 0) and letter sequences, as rows of a matrix."""

    def __init__(self, rows: list[tuple[str, int, str, int]], priors: dict[str, int]):
        import numpy as np

        self.languages = sorted(priors)
        place = {x: i for i, x in enumerate(self.languages)}
        self.prior = np.log(np.array([priors[x] for x in self.languages], float) / max(1, sum(priors.values())))
        self.known: dict[int, dict[str, int]] = {n: {} for n in range(ORDER + 1)}
        flat: list[list[float]] = []
        totals = Counter()
        for lang, n, _, count in rows:
            totals[lang, n] += count
        for lang, n, gram, count in rows:
            i = self.known[n].setdefault(gram, len(flat))
            if i == len(flat):
                flat.append([0.0] * len(self.languages))
            flat[i][place[lang]] += count
        self.logs = np.array(flat, float).reshape(-1, max(1, len(self.languages)))
        for n, table in self.known.items():
            at = np.array(list(table.values()), int)
            size = np.array([totals[x, n] for x in self.languages], float) + 0.5 * max(1, len(table))
            if len(at):
                self.logs[at] = np.log((self.logs[at] + 0.5) / size)
        self.logs = self.logs.astype("f4")

    def rows_of(self, word: str) -> list[int]:
        """The rows whose mean is the word's log frequency in each language: the word's, or its longest known sequences'."""
        i = self.known[0].get(word)
        if i is not None:
            return [i]
        marked = f"^{word}$"
        longest = [marked[at : at + ORDER] for at in range(max(1, len(marked) - ORDER + 1))]
        found = [*map(self.known[ORDER].get, longest)]
        if None in found:
            found = [self._shorter(x) if i is None else i for i, x in zip(found, longest)]
            return [i for i in found if i is not None]
        return found

    def _shorter(self, gram: str) -> int | None:
        for n in range(ORDER - 1, 0, -1):
            i = self.known[n].get(gram[:n])
            if i is not None:
                return i
        return None


class Scorer:
    """Scores texts; keeps what each piece between white space contributes, up to ``most`` pieces."""

    def __init__(self, model: Model, most: int = 300_000):
        import numpy as np

        self.model, self.most = model, most
        self.codes: dict[str, int] = {}
        self.rows = np.zeros((1024, len(model.languages) + 1), "f4")

    def _add(self, pieces: set[str]) -> None:
        """Keeps what new pieces contribute: the sum of their words' rows, and how many words."""
        import numpy as np

        flat, sizes, begins, counts = [], [], [], []
        begin = len(self.codes)
        for k, piece in enumerate(pieces, begin):
            self.codes[piece] = k
            begins.append(len(flat))
            word = piece.lower().strip(_AROUND)
            words = [word] if word.isalpha() else words_of(piece)
            counts.append(len(words))
            for x in words:
                found = self.model.rows_of(x)
                if found:
                    flat += found
                    sizes.append(len(found))
        end = len(self.codes)
        while end > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[begin:end] = 0
        self.rows[begin:end, -1] = counts
        if flat:
            sums = np.concatenate([np.zeros((1, len(self.model.languages))), np.cumsum(self.model.logs[np.array(flat)] * np.repeat(1 / np.array(sizes), sizes)[:, None], axis=0)])
            at = np.array([*begins, len(flat)])
            self.rows[begin:end, :-1] = sums[at[1:]] - sums[at[:-1]]

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its probability."""
        import numpy as np

        pieces = [(x or "").split() for x in texts]
        if len(self.codes) > self.most:
            self.codes.clear()
        new = set().union(*pieces) - self.codes.keys()
        if new:
            self._add(new)
        out = []
        for x in pieces:
            total = self.rows[np.fromiter(map(self.codes.__getitem__, x), np.int64, len(x))].sum(0, dtype="f8")
            if not total[-1] or not self.model.languages:
                out.append((UNKNOWN, 0.0))
                continue
            logs = total[:-1] + self.model.prior
            best = int(logs.argmax())
            out.append((self.model.languages[best], 1 / float(np.exp(logs - logs[best]).sum())))
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 2000, most: int = 30_000) -> Model:
    """Learns from about ``per_language`` documents of each language that are labelled and not held out.

    They are chosen by a hash of id and text. Words and sequences seen twice or more count, up to
    the ``most`` frequent of each kind and language, so that the model's size is bounded. Without
    labelled documents there is no language.
    """
    usable = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    priors = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # a row for each language
    share = F.lit(0.0)
    for lang, n in priors.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1e6
    counts = arrow_map(usable.where(dealt < share).select("lang", "text"), _count, "lang string, n int, gram string, count long")
    counts = counts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count")).where("count > 1")
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("count"), "gram"))
    rows = counts.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank").collect()  # at most `most` for each kind and language
    return Model([tuple(r) for r in rows], priors)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (the probability of lang_pred, 0 to 1) in place of columns so named.

    A null text or one without letters is ``und`` with score 0, as is every text if nothing was
    learned. Texts of one word or a million are scored whole. All rows and other columns stay.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for part in texts:
            listed = part.tolist()
            found = [x for s in runs([len(t or "") for t in listed], 1 << 20) for x in scorer(listed[s])]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    rest = docs.drop("lang_pred", "score")
    # Its values repeat; said to be nondeterministic, it isn't run again for a filter on its result.
    found = rest.withColumn("_found", predict.asNondeterministic()(F.col(text_col)))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")
