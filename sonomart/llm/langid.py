"""Language identification of words and spans.

A word's script, read off Unicode ranges, narrows the languages it can belong to; character n-grams of the
word score those that remain; Viterbi over the words of a text, with a penalty for each switch, labels spans
of mixed-language text. A text's language is the one that labels most of its letters.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` expected per language, drawn by a
hash of id and text) and has a fixed size: hashed n-gram buckets per language, so what reaches the driver and
the tasks does not grow with the corpus. Prediction reads every text whole in the task that scans it, in
pieces, without a shuffle; of a long text the scores of its words stay, some 30 bytes a word and language.

Defined results
---------------
* Null text, or text without a letter: ``und``, score 0, no spans. Combining marks alone are no letters.
* Kept columns may have any names but those of the results (``lang_pred``, ``score``, ``spans``), which is an error.
* Words of a script that no learned language uses may belong to any; they follow their neighbours.
* Equal scores: the language that comes first by code point. No labelled row at all: every text is ``und``.
* Each row is judged alone, so repeated rows give repeated results. Only the named columns are read, and only
  the text takes part in a prediction. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
SAMPLE_ROWS = 1500
BUCKET_BITS = 15
ORDERS = (1, 2, 3)
SWITCH_PENALTY = 12.0
SMOOTHING = 0.5
# A language is a candidate for a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.001
# Characters whose n-gram scores are held at once, for up to four languages; fewer for more languages.
PIECE_CHARS = 1 << 19
BATCH_CHARS = 1 << 20

# First code point of each range and its script; 0 is every other script.
SCRIPT_RANGES = (
    (0x0000, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6),
    (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 11), (0x0B80, 12), (0x0C00, 13), (0x0C80, 14),
    (0x0D00, 15), (0x0D80, 16), (0x0E00, 17), (0x0E80, 18), (0x0F00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22),
    (0x1200, 23), (0x13A0, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 24), (0x3100, 0), (0x3130, 22), (0x3190, 0),
    (0x31F0, 24), (0x3200, 0), (0x3400, 25), (0xA000, 0), (0xAC00, 22), (0xD7B0, 0), (0xF900, 25), (0xFB00, 1), (0xFB1D, 5),
    (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0), (0xFF21, 1), (0xFF66, 24), (0xFFA0, 0), (0x20000, 25), (0x32000, 0),
)
SCRIPTS = 26


@lru_cache(maxsize=1)
def _tables():
    """Per code point: is it part of a word, its lower case, its script, and is it a letter and no mark."""
    top = 0x110000
    letter, proper = np.zeros(top, dtype=bool), np.zeros(top, dtype=bool)
    lower = np.arange(top, dtype=np.uint32)
    for c in range(0x323B0):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L" or kind in ("Mn", "Mc"):
            letter[c], proper[c] = True, kind[0] == "L"
            if kind in ("Lu", "Lt"):
                small = chr(c).lower()
                if len(small) == 1:
                    lower[c] = ord(small)
    starts = [s for s, _ in SCRIPT_RANGES]
    script = np.zeros(top, dtype=np.uint8)
    for i, (start, kind) in enumerate(SCRIPT_RANGES):
        script[start:SCRIPT_RANGES[i + 1][0] if i + 1 < len(SCRIPT_RANGES) else top] = kind
    assert starts == sorted(starts)
    return letter, lower, script, proper


def script_of(char: str) -> int:
    """Script number of one character, straight from the ranges."""
    return SCRIPT_RANGES[bisect.bisect([s for s, _ in SCRIPT_RANGES], ord(char)) - 1][1]


@dataclass
class Words:
    """Words of a piece of text: code point positions, scripts, and hashed n-grams with their word."""
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    gram_starts: np.ndarray


def words_of(text: str) -> Words:
    letter, lower, script, proper = _tables()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = letter[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    # Marks belong to a word, but do not make one.
    letters = np.concatenate(([0], np.cumsum(proper[codes])))
    some = letters[end] > letters[start]
    start, end = start[some], end[some]
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none)
    # A space on either side of every word; n-grams are cut from this string and never span two words.
    low = np.where(inside, lower[codes], 32).astype(np.uint64)
    padded = np.concatenate(([np.uint64(32)], low, [np.uint64(32)]))
    spread = (padded + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    lengths = end - start
    # Position p of the padded string is a slot of the word from the space before it to the space behind it.
    size = lengths + 2
    first = np.cumsum(size) - size
    slot = np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(start, size)
    place = np.arange(len(slot)) - np.repeat(first, size)
    room = np.repeat(size, size) - place
    grams, owners = [], []
    owner = np.repeat(np.arange(len(start)), size)
    for n in ORDERS:
        fits = room >= n
        if n == 1:
            fits &= (place > 0) & (room > 1)
        at = slot[fits]
        h = np.full(len(at), n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ spread[at + i]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        grams.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        owners.append(owner[fits])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    grams, owners = grams[order], owners[order]
    return Words(start, end, script[codes[start]], grams, np.searchsorted(owners, np.arange(len(start))))


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # float32 [bucket, language]: log probability of the n-gram
    allowed: np.ndarray  # bool [script, language]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of buckets (>= 0) and scripts (-1 - script) per language, summed over the task."""
    grams: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held = grams.setdefault(lang, np.zeros(SCRIPTS + (1 << BUCKET_BITS), np.int64))
            for at in range(0, len(text), PIECE_CHARS):
                w = words_of(text[at:at + PIECE_CHARS])
                held[SCRIPTS:] += np.bincount(w.grams, minlength=1 << BUCKET_BITS)
                held[:SCRIPTS] += np.bincount(w.script, weights=w.end - w.start, minlength=SCRIPTS).astype(np.int64)
    for lang, held in grams.items():
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at - SCRIPTS, pa.int32()),
                                          pa.array(held[at], pa.int64())], names=["lang", "slot", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` rows of each language; rows without text or language do not count."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros((SCRIPTS, 0), bool))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, sample_rows / n)))])
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.filter(draw < F.element_at(share, F.col("lang"))).select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()
    languages = sorted(sizes)
    place = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((1 << BUCKET_BITS, len(languages)))
    letters = np.zeros((SCRIPTS, len(languages)))
    for r in counts:
        if r["slot"] >= 0:
            table[r["slot"], place[r["lang"]]] = r["n"]
        else:
            letters[r["slot"] + SCRIPTS, place[r["lang"]]] = r["n"]
    scores = np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * len(table))).astype(np.float32)
    allowed = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, scores, allowed)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """float32 [word, language]; languages that do not use the word's script are far behind."""
    summed = np.add.reduceat(model.scores[words.grams], words.gram_starts, axis=0)
    summed -= summed.max(axis=1, keepdims=True)
    # A long odd word counts as strong evidence, not as proof.
    np.maximum(summed, -2 * SWITCH_PENALTY, out=summed)
    return np.where(model.allowed[words.script], summed, np.float32(-4 * SWITCH_PENALTY))


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH_PENALTY) -> list[np.ndarray]:
    """Best label of every word of every text; texts advance together, one word a step."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    longest = int(lengths[0]) if len(lengths) else 0
    out = [np.zeros(len(s), np.int16) for s in scores]
    if not longest:
        return out
    offsets = np.cumsum(lengths) - lengths
    flat = np.concatenate([scores[i] for i in order])
    from_best = np.zeros(len(flat), np.int16)  # best label one word earlier
    stays = np.zeros(flat.shape, bool)  # is it better to have had the same label
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
    value = flat[offsets[:alive[0]]].copy()
    ends = np.zeros(len(order), np.int16)
    for t in range(1, longest + 1):
        going = alive[t] if t < longest else 0
        if going < len(value):
            ends[going:len(value)] = value[going:].argmax(axis=1)
            value = value[:going]
        if not going:
            break
        at = offsets[:going] + t
        best = value.argmax(axis=1)
        switched = value[np.arange(going), best][:, None] - np.float32(penalty)
        stay = value >= switched
        from_best[at], stays[at] = best, stay
        value = np.where(stay, value, switched) + flat[at]
        value -= value.max(axis=1, keepdims=True)
    labels = np.zeros(len(flat), np.int16)
    current = np.zeros(len(order), np.int16)
    for t in range(longest - 1, -1, -1):
        going = alive[t]
        started = alive[t + 1] if t + 1 < longest else 0
        current[started:going] = ends[started:going]
        at = offsets[:going] + t
        labels[at] = current[:going]
        if t:
            keep = stays[at, current[:going]]
            current[:going] = np.where(keep, current[:going], from_best[at])
    for k, i in enumerate(order):
        out[i] = labels[offsets[k]:offsets[k] + lengths[k]]
    return out


def label_texts(texts: list[str | None], model: Model, spans: bool = False) -> list[tuple]:
    """(language, score, spans) of each text; a span is (start, end, language) in code points."""
    scores, places = [], []
    piece = max(1024, PIECE_CHARS * 4 // max(4, len(model.languages)))
    for text in texts:
        some_scores, start, end = [np.zeros((0, len(model.languages)), np.float32)], [], []
        at = 0
        while text and model.languages and at < len(text):
            stop = min(len(text), at + piece)
            # Cut between words where a separator is near; a longer word is scored in two pieces.
            cut = max(text.rfind(" ", at, stop), text.rfind("\n", at, stop)) if stop < len(text) else -1
            stop = cut if cut > at else stop
            w = words_of(text[at:stop])
            if len(w.start):
                some_scores.append(word_scores(w, model))
                start.append(w.start + at), end.append(w.end + at)
            at = stop
        scores.append(np.concatenate(some_scores))
        none = np.zeros(0, np.int64)
        places.append((np.concatenate(start) if start else none, np.concatenate(end) if end else none))
    out = []
    for (start, end), labels in zip(places, viterbi(scores)):
        if not len(labels):
            out.append((UNDETERMINED, 0.0, []))
            continue
        letters = np.bincount(labels, weights=end - start, minlength=len(model.languages))
        best = int(letters.argmax())
        found = []
        if spans:
            runs = np.flatnonzero(np.diff(np.concatenate(([-1], labels, [-1]))))
            found = [{"start": int(start[a]), "end": int(end[b - 1]), "lang": model.languages[labels[a]]}
                     for a, b in zip(runs[:-1], runs[1:])]
        out.append((model.languages[best], float(letters[best] / letters.sum()), found))
    return out


def _predicted(model: Model, spans: bool):
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.cumsum(np.array([s or 0 for s in batch.column("n").to_pylist()], dtype=np.int64))
            at = 0
            while at < batch.num_rows:
                base = lengths[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(lengths, base + BATCH_CHARS, side="right")))
                part = batch.slice(at, stop - at)
                found = label_texts(part.column("text").to_pylist(), model, spans)
                keep = [part.column(i) for i, name in enumerate(part.schema.names) if name not in ("text", "n")]
                names = [name for name in part.schema.names if name not in ("text", "n")]
                new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                if spans:
                    new.append(pa.array([f[2] for f in found], span_type))
                yield pa.RecordBatch.from_arrays(keep + new, names=names + ["lang_pred", "score", "spans"][: len(new)])
                at = stop
    return run


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", spans: bool = False) -> DataFrame:
    """Columns ``keep`` plus lang_pred and score, and the language spans where asked for."""
    clash = {k.lower() for k in keep} & {"lang_pred", "score", *(["spans"] if spans else [])}
    if clash:
        raise ValueError(f"rename {sorted(clash)} before labelling")
    # Kept columns travel under numbers, so their names cannot clash with those used here.
    kept = [F.col(k).alias(f"in_{i}") for i, k in enumerate(keep)]
    rows = docs.select(*kept, F.col(text_col).alias("text"), F.length(text_col).alias("n"))
    fields = "".join(f"`in_{i}` {docs.select(k).schema[0].dataType.simpleString()}, " for i, k in enumerate(keep))
    extra = "lang_pred string, score double" + (", spans array<struct<start:bigint,end:bigint,lang:string>>" if spans else "")
    found = rows.mapInArrow(_predicted(model, spans), fields + extra)
    return found.toDF(*keep, *found.columns[len(keep):])


def held_out(id_col: str) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))
