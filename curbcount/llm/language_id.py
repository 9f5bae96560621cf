"""Language of a text: averaged hashed subword embeddings under a linear softmax, trained by SGD."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import columns, record_of, release, schema_of, slices, whole

#: The training sample is bounded: so many labelled rows in all, of texts up to so many characters, and
#: so many languages (the most frequent ones).
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 8000
MAX_LANGUAGES = 150
BUCKETS = 1 << 16
DIMENSIONS = 16
SIZES = (2, 3, 4)
EPOCHS = 6
RATE = 0.5
#: Share of accepted texts that may be wrong, and of rightly recognised held-back rows that the threshold may reject.
RISK = 0.01
REJECTED_GOOD = 0.0005
_ANY = list("abcdefghijklmnopqrstuvwxyz")
UNKNOWN = "und"
SLICE_BYTES = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every subword: runs of characters within a word and its two borders."""
    lowered = [b.lower() for b in bodies]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(bodies)), [len(b) + 1 for b in lowered])
    codes = np.where(_letters()[codes], codes, np.uint64(0))
    # every run of other characters is one border; the first text has one before it as well
    stays = np.concatenate([[True], (codes[1:] > 0) | (codes[:-1] > 0)])
    codes, owner = np.concatenate([[np.uint64(0)], codes[stays]]), np.concatenate([[0], owner[stays]])
    docs, buckets = [], []
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        mixed = np.full(n, size, np.uint64)
        inner = np.ones(n, bool)
        for k in range(size):
            mixed = (mixed ^ codes[k : n + k]) * _GOLD
            mixed ^= mixed >> np.uint64(29)
            if 0 < k < size - 1:
                inner &= codes[k : n + k] > 0
        if size == 2:  # two borders make no subword
            inner &= (codes[:n] > 0) | (codes[1 : n + 1] > 0)
        docs.append(owner[size - 1 :][inner] if size == 2 else owner[1 : n + 1][inner])
        buckets.append((mixed[inner] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(buckets)


@dataclass
class LanguageModel:
    """Languages, the weight every bucket has for each of them, biases, temperature, threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text, and how many subwords it has. An average is linear, so weights are added directly."""
        doc, bucket = features(bodies)
        count = np.bincount(doc, minlength=len(bodies))
        total = np.stack([np.bincount(doc, self.table[bucket, k], minlength=len(bodies)) for k in range(len(self.languages))], axis=1)
        return total / np.maximum(count, 1)[:, None] + self.bias, count

    def predict(self, bodies: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability; ``und`` and zero for texts without a letter."""
        if not self.languages:
            return [UNKNOWN] * len(bodies), np.zeros(len(bodies))
        logits, count = self.logits(bodies)
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        return [self.languages[k] if n else UNKNOWN for k, n in zip(best, count)], np.where(count > 0, p.max(axis=1), 0.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 7) -> LanguageModel:
    """From (text, language) rows. Every fifth row is held back to calibrate scores and threshold."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = sorted(rows)
    order = rng.permutation(len(rows))
    held = [rows[i] for i in order[::5]] if len(rows) >= 50 else rows
    own = [rows[i] for k, i in enumerate(order) if k % 5] if len(rows) >= 50 else rows
    # a short stretch of most texts as well, so that short texts are known too
    examples = [(t, lang) for t, lang in own] + [(_stretch(t, rng), lang) for t, lang in own]
    bags = []
    for text, lang in examples:
        _, bucket = features([text])
        if len(bucket):
            ids, n = np.unique(bucket, return_counts=True)
            bags.append((ids, n / n.sum(), languages.index(lang)))
    embed = rng.normal(0, 0.3, (BUCKETS, DIMENSIONS))
    weight, bias = rng.normal(0, 0.3, (DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, done = max(1, EPOCHS * len(bags)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            ids, share, lang = bags[k]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ embed[ids]
            error = _softmax(mean @ weight + bias)
            error[lang] -= 1
            back = weight @ error
            weight -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # each bucket's share of the average is small; its own step is scaled up to be felt
            embed[ids] -= rate * np.outer(np.minimum(1.0, share * len(ids)), back)
    model = LanguageModel(languages, (embed @ weight).astype(np.float64), bias)
    _calibrate(model, held)
    return model


def _stretch(text: str, rng: np.random.Generator) -> str:
    at = int(rng.integers(0, max(1, len(text) - 60)))
    return text[at : at + 60]


def _calibrate(model: LanguageModel, held: list[tuple[str, str]]) -> None:
    """Temperature of least log loss, and the threshold of the stated risk."""
    rng = np.random.default_rng(len(held))
    held = [*held, *((_stretch(t, rng), lang) for t, lang in held)]
    logits, count = model.logits([t for t, _ in held])
    truth = np.array([model.languages.index(lang) for _, lang in held])
    logits, truth = logits[count > 0], truth[count > 0]
    if not len(truth):
        return
    # smoothed targets keep the temperature finite where every held-back row is recognised
    others = max(1, len(model.languages) - 1)
    doubt = 1 / (len(truth) + 2) if others > 1 or len(model.languages) == 2 else 0.0
    grid = np.geomspace(0.05, 20, 80)
    loss = []
    for t in grid:
        log_p = np.log(_softmax(logits / t) + 1e-300)
        true = log_p[np.arange(len(truth)), truth]
        loss.append(-((1 - doubt) * true + doubt / others * (log_p.sum(axis=1) - true)).mean())
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / model.temperature)
    right = p.argmax(axis=1) == truth
    score = p.max(axis=1)
    # held-back errors and texts of no language the model may say: characters of held-back words put in any order
    shuffled, count = model.logits([_jumbled(t, rng) for t, _ in held])
    foreign = _softmax(shuffled[count > 0] / model.temperature).max(axis=1) if (count > 0).any() else np.zeros(0)
    model.threshold = _threshold(score[right], score[~right], foreign)


def _threshold(right: np.ndarray, wrong: np.ndarray, foreign: np.ndarray) -> float:
    """The least score at which accepted texts are wrong no more often than ``RISK``, foreign ones a tenth of all.

    It is lowered where it would reject more than ``REJECTED_GOOD`` of the texts that are recognised: coverage of good
    texts goes before risk, and a model that cannot tell them apart rejects little.
    """
    if not len(right):
        return 0.0
    most = float(np.quantile(right, REJECTED_GOOD))
    weight = len(right) / (9 * max(1, len(foreign)))
    score = np.concatenate([right, wrong, foreign])
    bad = np.concatenate([np.zeros(len(right)), np.ones(len(wrong)), np.full(len(foreign), weight)])
    mass = np.concatenate([np.ones(len(right) + len(wrong)), np.full(len(foreign), weight)])
    order = np.argsort(-score, kind="stable")
    risk = np.cumsum(bad[order]) / np.cumsum(mass[order])
    last = np.append(np.diff(score[order]) != 0, True)  # equal scores are accepted together
    safe = np.flatnonzero((risk <= RISK) & last)
    least = float(score[order][safe[-1]]) if len(safe) else 1.0
    return min(least, most)


def _jumbled(text: str, rng: np.random.Generator) -> str:
    """Words of the text's length in characters that are not those of its language: drawn from all letters evenly."""
    return " ".join("".join(rng.choice(_ANY, max(1, len(w)))) for w in text[:200].split())


def held_out(id_col: Column) -> Column:
    """The fold that is never learned from; rows without id are in neither fold and count as not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Trained on a bounded sample of the labelled rows outside the held-out fold.

    Rows with text are taken by a hash of id and text, as many of each language, and in its order, so the sample is the
    same however the table is cut, also where ids repeat. Of texts beyond ``SAMPLE_CHARS`` a stretch is taken, at a place that the
    hash draws, so languages of long texts are learned like others. Only counts by language and the sample reach the driver.
    """
    labelled = columns(docs, id=id_col, text=text_col, lang=lang_col).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")) & (F.length("text") > 0)
    )
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return train([])
    each = max(1, sample_rows // len(counts))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, each / r["count"]))])
    draw = F.xxhash64("id", "text")
    chosen = labelled.where(F.pmod(draw, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    # of longer texts a stretch from a place that the hash draws
    begin = 1 + F.pmod(F.xxhash64(draw), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int")
    some = chosen.select(F.substring("text", begin, F.lit(SAMPLE_CHARS)).alias("text"), "lang", draw.alias("draw"))
    first = some.orderBy("draw", "text", "lang").limit(2 * sample_rows)
    return train([(r["text"], r["lang"]) for r in first.collect()])


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """record (all columns but the text), text if kept, lang_pred, score, rejected.

    ``und`` with score 0, and rejected, if the text is null or has no letter; otherwise a learned language,
    rejected if its calibrated score is below the model's threshold. A model without languages says
    ``und`` and rejects nothing. Whole texts are scored; rows stay apart whatever their ids.
    """
    frame = record_of(docs, [text_col], text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = ["record", "text"][: 1 + keep_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own = shared.value
        for part in slices(batches, "text", SLICE_BYTES):
            langs, score = own.predict([t or "" for t in part["text"].to_pylist()])
            rejected = [bool(own.languages) and (lang == UNKNOWN or s < own.threshold) for lang, s in zip(langs, score)]
            yield pa.record_batch([*(part[c] for c in carried), pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], [*carried, "lang_pred", "score", "rejected"])

    return frame.mapInArrow(run, schema_of(frame, carried, "lang_pred string, score double, rejected boolean"))


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose language is rejected; whole rows, all columns, any names."""
    scored = predict(docs, fit(docs, id_col, text_col, lang_col), text_col).where("NOT rejected")
    return whole(scored, docs.columns, **{text_col: "text"})
