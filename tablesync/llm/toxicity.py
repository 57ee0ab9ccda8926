"""Toxicity by compression distance.

Two zstandard dictionaries share a base, trained by zstandard on ordinary text. The ordinary one is that base; the toxic
one has in front of it the strings that mark toxic text: beginnings of words that a fair part of the toxic sample holds
and the ordinary sample hardly does, the most frequent last. With a shared base the two agree on any window, except
where the toxic strings help. A text is cut into windows of ``Settings.words`` words; how many bytes less a window takes
with the toxic dictionary is its evidence. A logistic model of the evidence gives the score; it is calibrated on each
half of the sample with toxic strings of the other half.

What is fitted comes from at most ``Settings.toxic`` + ``Settings.ordinary`` labelled rows, texts of at most
``Settings.sample_bytes`` bytes, one of equal texts, smallest hashes of identifiers first; it does not grow with the
corpus. Whole texts are scored, in the tasks that read them, without a shuffle.

Null and empty texts have no evidence and get the score of none. Null labels are no labels. Without labels of both
classes every score is 0. Repeated rows get equal scores. An empty table gives an empty result. Columns beside
identifier and text are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import batch_parts, unused, whole


@dataclass(frozen=True)
class Settings:
    words: int = 12
    level: int = 12
    base_bytes: int = 16384
    #: Pieces of ordinary text that the base is trained on at most, spread over all sampled texts.
    base_pieces: int = 40_000
    toxic: int = 2000
    ordinary: int = 4000
    sample_bytes: int = 16384
    #: A toxic string is in this part of the toxic sample at least, and this many times as frequent there.
    support: float = 0.02
    ratio: float = 10.0
    longest: int = 16
    #: So many uses in one text count.
    uses: int = 8


#: ASCII controls and punctuation become spaces.
_SPACED = bytes(32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in range(256))


def plain(text: str) -> bytes:
    """Lower case, words parted by one space, a space at both ends."""
    return b" " + b"".join(w + b" " for w in text.lower().encode("utf-8", "replace").translate(_SPACED).split())


@dataclass
class Model:
    base: bytes = b""
    strings: list[bytes] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)  # constant, then one for each evidence
    settings: Settings = Settings()

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return tuple(self._compressor(content) for content in (self.base, b"".join(self.strings) + self.base))

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=self.settings.level)
        return zstandard.ZstdCompressor(level=self.settings.level, dict_data=held, write_content_size=False)


def windows(words: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each window, the spaces around it included."""
    space = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    start = space[:-1:size]
    end = space[size::size]
    if len(end) < len(start):
        end = np.append(end, space[-1])
    return start, end + 1 - start


def _lengths(compressor, buffer: bytes, places: bytes, n: int) -> np.ndarray:
    packed = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(buffer, places))
    return np.fromiter(map(len, packed), np.int64, n)


def evidence(texts: list[bytes], ordinary, toxic, size: int) -> np.ndarray:
    """For each text: mean and largest gain of a window, share and logarithm of the number of windows that gain two bytes."""
    out = np.zeros((len(texts), 4))
    starts, lengths, owners, at = [], [], [], 0
    for k, text in enumerate(texts):
        start, length = windows(text, size)
        starts.append(start + at)
        lengths.append(length)
        owners.append(np.full(len(start), k))
        at += len(text)
    owner = np.concatenate(owners) if owners else np.zeros(0, int)
    if not len(owner):
        return out
    buffer = b"".join(texts)
    places = np.stack([np.concatenate(starts), np.concatenate(lengths)], axis=1).astype(np.uint64).tobytes()
    gain = _lengths(ordinary, buffer, places, len(owner)) - _lengths(toxic, buffer, places, len(owner))
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    count = np.diff(np.append(first, len(owner)))
    many = np.add.reduceat((gain >= 2).astype(float), first)
    rows = owner[first]
    out[rows, 0] = np.add.reduceat(gain, first) / count
    out[rows, 1] = np.maximum.reduceat(gain, first)
    out[rows, 2] = many / count
    out[rows, 3] = np.log1p(many)
    return out


def toxic_strings(toxic: list[bytes], ordinary: list[bytes], settings: Settings) -> list[bytes]:
    """Beginnings of words that mark toxic text, rarest first.

    Each is the shortest that marks it, made longer while nearly as many texts hold it.
    """

    def beginnings(text: bytes) -> Counter:
        found = Counter()
        for word, n in Counter(text.split()).items():
            spaced = b" " + word + b" "
            for k in range(4, min(len(spaced), settings.longest) + 1):
                found[spaced[:k]] += n
        return found

    least = max(3, settings.support * len(toxic))
    texts, inside, outside = Counter(), Counter(), Counter()
    for text in toxic:
        found = beginnings(text)
        texts.update(found.keys())
        inside.update({s: min(n, settings.uses) for s, n in found.items()})
    texts = {s: n for s, n in texts.items() if n >= least}
    for text in ordinary:
        outside.update({s: min(n, settings.uses) for s, n in beginnings(text).items() if s in texts})
    marks = {s for s in texts if (inside[s] + 0.5) / (len(toxic) + 1) > settings.ratio * (outside[s] + 0.5) / (len(ordinary) + 1)}
    chosen = {}
    for mark in sorted(marks, key=len):
        if any(mark[:n] in chosen for n in range(4, len(mark))):
            continue
        string = mark
        while longer := [s for s in (string + bytes([c]) for c in range(256)) if texts.get(s, 0) >= 0.7 * texts[mark]]:
            string = longer[0]
        chosen[mark] = (texts[string], string)
    return [s for _, s in sorted(chosen.values())]


def _base(ordinary: list[bytes], size: int, pieces: int) -> bytes:
    """A dictionary from at most ``pieces`` pieces, spread evenly over all texts."""
    samples = [w for t in ordinary for w in (t[k : k + 96] for k in range(0, len(t), 96))]
    samples = samples[:: max(1, -(-len(samples) // pieces))]
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b"".join(samples)[:size]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model, lightly regularised, by Newton's steps."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) * 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate((w[:1], w[1:] / scale))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """From texts (doc_id, text) and labels (doc_id, toxic: 0 or 1). Only the drawn labels meet the texts, broadcast."""
    drawn = [
        labels.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        for kind, n in ((1, settings.toxic), (0, settings.ordinary))
    ]
    usable = docs.select("doc_id", "text").where(F.octet_length("text").between(1, settings.sample_bytes))
    some = sorted(usable.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").collect(), key=lambda r: (r.doc_id, r.toxic, r.text))
    rows = dict.fromkeys((r.toxic, plain(r.text)) for r in some)
    by = {kind: [t for k, t in rows if k == kind and len(t) > 1] for kind in (0, 1)}
    if min(map(len, by.values())) < 2:
        return Model(settings=settings)
    model = Model(_base(by[0], settings.base_bytes, settings.base_pieces), toxic_strings(by[1], by[0], settings), [], settings)
    x, y = [], []
    for part in (0, 1):
        seen, unseen = ({k: v[p::2] for k, v in by.items()} for p in (part, 1 - part))
        trial = Model(model.base, toxic_strings(seen[1], seen[0], settings), [], settings)
        x.append(evidence(unseen[0] + unseen[1], *trial.compressors(), settings.words))
        y += [0.0] * len(unseen[0]) + [1.0] * len(unseen[1])
    model.weights = _logistic(np.concatenate(x), np.array(y)).tolist()
    return model


def _scores(model: Model, texts: list[str], ordinary, toxic) -> np.ndarray:
    if not model.weights:
        return np.zeros(len(texts))
    z = model.weights[0] + evidence([plain(t) for t in texts], ordinary, toxic, model.settings.words) @ np.array(model.weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scored(shared, below: float | None = None):
    """Batches with the score of the text, the last column, in its place; or without it, and only rows scored below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        both = model.compressors()
        for batch in batches:
            for part in batch_parts(batch):
                kept, names = part.columns[:-1], part.schema.names[:-1]
                scores = _scores(model, part.column(part.num_columns - 1).to_pylist(), *both)
                if below is None:
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], names=[*names, "score"])
                else:
                    yield part.select(range(len(kept))).filter(pa.array(scores < below))

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted of every row; doc_id keeps its type."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(_scored(shared), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs, all columns, that are not predicted to be toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(unused("whole", docs.columns), whole(text)).mapInArrow(_scored(shared, 0.5), docs.schema)
