"""Language identification, words first.

A word that the model knows scores by its log frequency in each language. Any other word falls back to its character
n-grams, first the longest, then shorter and shorter ones until some are known; their log frequencies are averaged. A
text's language has the largest sum over all its words; the score is its share after a softmax of the mean per word,
sharpened by the square root of the number of words.

Words and n-grams are counted by Spark in a sample of at most ``Settings.rows`` texts and ``Settings.language_bytes`` bytes a
language, drawn by the hash of the identifier; a language with fewer texts than that is learned from all of them, however long
they are, and from one of its longer texts if even that exceeds the bytes. What the driver gets are the most frequent items, of
which a language has fewer the more languages there are (``Settings.cells``), so the model does not grow with the corpus. Only
the ``Settings.languages`` most frequent languages are learned; documents of others are given to one of these.
Whole texts are scored, in the tasks that read them, without a shuffle.

A null text, and one without a letter, is ``und`` with score 0. Where the model has no evidence at all, or the sums tie,
the language that comes first by name is returned. Rows without a language are not learned from; without any language
everything is ``und``. Repeated rows get equal results. Columns beside identifier and text are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, batch_parts, whole

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    rows: int = 2000
    languages: int = 400
    language_bytes: int = 8 << 20
    words: int = 20_000
    grams: int = 20_000
    #: Kept items times languages of one table of the model, at most.
    cells: int = 8_000_000
    longest: int = 5
    #: A word's evidence for a language is at most this much below that for its best one.
    floor: float = 6.0


#: ASCII characters that are no letters part words; apostrophes do too.
_PARTING = {c: " " for c in range(128) if not chr(c).isalpha()} | {0xAB: " ", 0xBB: " ", 0xBF: " ", 0xA1: " ", 0x2019: " ", 0x201C: " ", 0x201D: " ", 0x2026: " "}


def words(text: str) -> list[str]:
    return text.lower().translate(_PARTING).split()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[k : k + n] for k in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    known: list[dict[str, np.ndarray]] = field(default_factory=list)  # words, then n-grams from the longest
    settings: Settings = Settings()

    def word(self, word: str) -> np.ndarray:
        if word in self.known[0]:
            return self.known[0][word]
        for n, table in zip(range(self.settings.longest, 0, -1), self.known[1:]):
            found = [table[g] for g in grams(word, n) if g in table]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.languages))


def _logs(counts: dict[str, dict[str, int]], totals: dict[str, int], floor: float) -> dict[str, np.ndarray]:
    """Log frequency of each kept item by language, less that of its best language."""
    kept = {item for c in counts.values() for item in c}
    totals = [totals.get(lang, 0) + len(kept) * 0.1 + 1 for lang in counts]
    out = {}
    for item in kept:
        logs = np.array([math.log((c.get(item, 0) + 0.1) / t) for c, t in zip(counts.values(), totals)])
        out[item] = np.maximum(logs - logs.max(), -floor)
    return out


_COUNTS = "lang string, size int, item string, n long"


def _batch(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    kinds = (pa.string(), pa.int32(), pa.string())
    columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], names=["lang", "size", "item", "n"])


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch_parts(batch):
            yield _batch(Counter((lang, 0, w) for lang, text in zip(*(c.to_pylist() for c in part.columns)) for w in words(text)))


def _counted_grams(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for lang, word, times in zip(*(c.to_pylist() for c in batch.columns)):
                for n in range(1, longest + 1):
                    for g in grams(word, n):
                        found[lang, n, g] += times
            yield _batch(found)

    return run


def _sampled(labelled: DataFrame, settings: Settings) -> tuple[list[str], DataFrame]:
    """Languages by name, and lang, text of the rows that are learned from."""
    texts = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sized = texts.withColumns({"place": place, "size": F.octet_length("text")})
    first = F.min(F.struct("size", "place")).alias("least")  # the shortest text, should all be too long
    held = sized.groupBy("lang").agg(F.count("*").alias("count"), F.sum("size").alias("bytes"), first).orderBy(F.desc("count"), "lang").limit(settings.languages).collect()
    share, least = F.lit(-1.0), F.lit(False)
    for r in held:
        of = F.col("lang") == r["lang"]
        part = min(1.0, settings.rows / r["count"], settings.language_bytes / max(r["bytes"], 1))
        share = F.when(of, F.lit(part)).otherwise(share)
        least = least | (of & (F.col("size") == r["least"]["size"]) & (F.col("place") == r["least"]["place"]))
    return sorted(r["lang"] for r in held), sized.where((F.col("place") < share) | least).select("lang", "text").distinct()


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """From rows of doc_id, text, lang."""
    languages, sample = _sampled(labelled, settings)
    if not languages:
        return Model([], settings=settings)
    scratch = Scratch(labelled.sparkSession, "language-counts")
    total = F.sum("n").alias("n")
    by_word = scratch.write("words", sample.mapInArrow(_counted_words, _COUNTS).groupBy("lang", "size", "item").agg(total))
    spread = by_word.select("lang", "item", "n").repartition("item")
    by_gram = spread.mapInArrow(_counted_grams(settings.longest), _COUNTS).groupBy("lang", "size", "item").agg(total)
    counts = scratch.write("counts", by_word.unionByName(by_gram))
    few = settings.cells // len(languages) ** 2
    most = F.when(F.col("size") == 0, min(settings.words, few)).otherwise(min(settings.grams, few))
    rank = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "item"))
    kept = counts.where("n > 1").withColumn("rank", rank).where(F.col("rank") <= most).select("size", "item").distinct()
    sums = {(r["lang"], r["size"]): r["n"] for r in counts.groupBy("lang", "size").agg(total).collect()}
    tables = [{lang: {} for lang in languages} for _ in range(settings.longest + 1)]
    rows = counts.join(kept, ["size", "item"]).select("lang", "size", "item", "n").toArrow()
    for lang, size, item, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "size", "item", "n"))):
        tables[size][lang][item] = n
    scratch.drop("words", "counts")
    order = [0, *range(settings.longest, 0, -1)]
    known = [_logs(tables[size], {lang: sums.get((lang, size), 0) for lang in languages}, settings.floor) for size in order]
    return Model(languages, known, settings)


class _Scorer:
    """Evidence of words, each looked up once; what is kept is bounded."""

    KEPT = 200_000

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.evidence = np.zeros((1 << 12, len(self.model.languages)))

    def score(self, text: str) -> tuple[str, float]:
        if not self.model.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found = words(text)
        if len(self.place) > self.KEPT:
            self._clear()
        for word in set(found).difference(self.place):
            k = len(self.place)
            if k == len(self.evidence):
                self.evidence = np.concatenate((self.evidence, np.zeros_like(self.evidence)))
            self.evidence[k] = self.model.word(word)
            self.place[word] = k
        sums = self.evidence[list(map(self.place.__getitem__, found))].sum(axis=0)
        best = int(sums.argmax())
        parts = np.exp((sums - sums[best]) / math.sqrt(max(len(found), 1)))
        return self.model.languages[best], float(parts[best] / parts.sum())


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            for part in batch_parts(batch):
                found = [scorer.score(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row; doc_id keeps its type."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    return rows.mapInArrow(_predicted(shared), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
