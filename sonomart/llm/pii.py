"""Personal data: exact base patterns, plus spans found by weak supervision.

Regex, gazetteer and context labelers vote on candidate spans (credentials, local phone and identity
numbers). The votes of all documents are counted by pattern, so expectation-maximisation over labeler
reliabilities runs on a histogram whose size depends on the number of labelers and features only. Its posteriors
are the targets of a logistic span classifier that also sees what the labelers do not vote on: the length of a span,
its kinds of characters and how varied they are. Its weights become literals of the scan: detection is one narrow
pass without a shuffle, and no document, source or copy group can become a hot key.

Positions are running sums over the matches and the text between them, so they are code points whatever the script, and
a text with many matches costs little more than linear time. Patterns are
possessive rewrites of the published ones: same matches, linear time, no recursion on long runs.

Defined results
---------------
* Null or empty text has no span. An empty table gives an empty result and a classifier that adds nothing.
* Each row is judged alone, so repeated rows and ids give repeated results.
* Spans of different kinds may overlap; redaction merges overlapping spans under the first one's tag.
* Only the named columns are read; ``redact`` keeps all others untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base kinds in report order.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP_RANGE = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
BASE_KINDS = ("email", "ip", "card", "phone")

# Candidates of the learned part.
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}+"
CONTACT = (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
           r"|(?<![+0-9(.-])(?<!\+[0-9]{1,3}[ -])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
LEARNED_KINDS = ("secret", "contact")

# Words before a span that speak for or against it, and known beginnings of credentials.
CUES_FOR = ("token", "secret", "password", "passwd", "api_key", "apikey", "key", "bearer", "ssn", "social security",
            "phone", "tel", "call", "mobile", "fax", "contact")
CUES_AGAINST = ("version", "isbn", "issn", "doi", "commit", "sha256", "md5", "checksum", "uuid", "order", "part no")
CREDENTIAL_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "sk-", "sk_live_", "pk_live_", "xox", "AIza", "eyJ", "glpat-")
CONTEXT_CHARS = 24
LABELERS = ("shape", "mixture", "gazetteer", "context", "counter_context", "dull")
# Features of a span, in BUCKETS buckets each: bounds of its length and of its number of distinct characters; and the
# number of kinds of characters in it.
FEATURES, BUCKETS = ("length", "kinds", "variety"), 4
LENGTHS, VARIETIES = (16, 28, 40), (8, 12, 16)
# Doublings of a running sum or maximum: more elements than an array can hold.
_DOUBLINGS = 31
# Code points of the slices that a text is cut from.
_SLICE = 1000


@dataclass(frozen=True)
class Model:
    """Votes of labelers become a probability: ``bias + sum(weights[labeler][vote])``."""
    bias: float
    kind: tuple[float, ...]
    weights: tuple[tuple[float, float], ...]  # (vote against, vote for) per labeler
    features: tuple[tuple[float, ...], ...]  # by bucket, per feature
    reliability: tuple[tuple[float, float], ...] = ()  # EM: right when voting on (negatives, positives)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, merge) -> Column:
    """Running totals of an array, each with its own element, by doubling: n log n steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(_DOUBLINGS)])

    def double(v: Column) -> Column:
        wanted = F.filter(steps, lambda step: step < F.size(v))
        return F.aggregate(wanted, v, lambda held, step: F.transform(
            held, lambda x, i: F.when(i < step, x).otherwise(merge(x, F.get(held, i - step)))))

    return _once(values, double)


def find(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit, before) of all leftmost matches; null where there is none."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    parts = F.zip_with(gaps, hits, lambda g, h: F.struct(
        F.length(g).alias("skip"), F.length(h).alias("n"), h.alias("hit"),
        F.lower(F.right(g, F.lit(CONTEXT_CHARS))).alias("before")))
    found = _once(parts, lambda v: F.zip_with(v, _running(F.transform(v, lambda x: x["skip"] + x["n"]), lambda x, y: x + y), lambda x, end: F.struct(
        (end - x["n"]).alias("start"), end.alias("end"), x["hit"].alias("hit"), x["before"].alias("before"))))
    return F.when(text.rlike(pattern), found)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _is_card(hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)


def _is_phone(hit: Column) -> Column:
    return F.length(F.regexp_replace(hit, "[^0-9]", "")).between(8, 15)


_CHECKS = {
    "email": (EMAIL, None),
    "ip": (IP, lambda hit: hit.rlike(_IP_RANGE)),
    "card": (CARD, _is_card),
    "phone": (PHONE, _is_phone),
}


def _kept(found: Column, check) -> Column:
    none = F.array().cast("array<struct<start:int,end:int>>")
    kept = found if check is None else F.filter(found, lambda x: check(x["hit"]))
    return F.coalesce(F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))), none)


def _votes(kind: str, x: Column) -> list[Column]:
    """One vote per labeler: 1 for, 0 against, -1 abstains."""
    hit, before = x["hit"], x["before"]
    yes = lambda c: F.when(c, 1).otherwise(-1)
    no = lambda c: F.when(c, 0).otherwise(-1)
    either = lambda c: F.when(c, 1).otherwise(0)
    alternatives = lambda words: r"\b(?:" + "|".join(words) + r")\b"
    starts = hit.rlike("^(?:" + "|".join(CREDENTIAL_STARTS) + ")")
    if kind == "secret":
        shape = either(hit.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+)$"))
        mixture = either(hit.rlike(r"(?:[0-9]+[A-Za-z_-]+){4}"))
    else:
        shape = either(hit.rlike(r"^(?:(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|\(?[2-9][0-9]{2}.*)$"))
        mixture = yes(hit.rlike(r"[()]|-"))
    return [shape, mixture, yes(starts), yes(before.rlike(alternatives(CUES_FOR))),
            no(before.rlike(alternatives(CUES_AGAINST))), no(hit.rlike(r"^(.)\1+$|^[0-9]+$|0123456789|1234567890"))]


def _candidates(text: Column, kind: str) -> Column:
    """Array of (start, end, votes, features) of one learned kind; null where there is none."""
    found = find(text, SECRET if kind == "secret" else CONTACT)
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.array(*_votes(kind, x)).alias("votes"),
                                                 F.array(*_features(x["hit"])).alias("features")))


def _features(hit: Column) -> list[Column]:
    """A bucket from 0 for each feature."""
    above = lambda c, bounds: sum((c >= b).cast("int") for b in bounds)
    kinds = sum(hit.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return [above(F.length(hit), LENGTHS), kinds - 1, above(F.size(F.array_distinct(F.split(hit, ""))), VARIETIES)]


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = 50):
    """Posterior of each vote pattern and the labelers' reliabilities, from pattern counts.

    Two hidden classes; labelers err independently. Deterministic start: labelers are right 4 times of 5.
    """
    patterns = sorted(counts)
    votes = np.array(patterns, dtype=np.int64).reshape(len(patterns), -1)
    n = np.array([counts[p] for p in patterns], dtype=np.float64)
    right = np.full((votes.shape[1], 2), 0.8)
    prior = 0.5
    posterior = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        log_odds = np.full(len(patterns), np.log(prior / (1 - prior)))
        for k in range(votes.shape[1]):
            log_odds += np.where(votes[:, k] == 1, np.log(right[k, 1] / (1 - right[k, 0])),
                                 np.where(votes[:, k] == 0, np.log((1 - right[k, 1]) / right[k, 0]), 0.0))
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))
        prior = float(np.clip((posterior @ n + 1) / (n.sum() + 2), 0.02, 0.98))
        for k in range(votes.shape[1]):
            for truth, weight in ((0, 1 - posterior), (1, posterior)):
                hit = (n * weight)[votes[:, k] == truth].sum()
                voted = (n * weight)[votes[:, k] >= 0].sum()
                right[k, truth] = np.clip((hit + 4) / (voted + 5), 0.05, 0.95)
    return dict(zip(patterns, posterior)), right


def _design(kind: int, votes, features) -> list[float]:
    row = [1.0, *[float(kind == k) for k in range(len(LEARNED_KINDS))]]
    for v in votes:
        row += [float(v == 0), float(v == 1)]
    return row + [float(f == b) for f in features for b in range(BUCKETS)]


def train(histogram: dict[tuple[int, tuple[int, ...], tuple[int, ...]], int], ridge: float = 1.0) -> Model:
    """EM over the vote patterns, then a ridge logistic regression of its posteriors on votes and features (Newton steps)."""
    votes_only: dict[tuple[int, ...], int] = {}
    for (_, votes, _), n in histogram.items():
        votes_only[votes] = votes_only.get(votes, 0) + n
    if not votes_only:
        return Model(-10.0, (0.0,) * len(LEARNED_KINDS), ((0.0, 0.0),) * len(LABELERS), ((0.0,) * BUCKETS,) * len(FEATURES))
    posterior, right = expectation_maximisation(votes_only)
    keys = sorted(histogram)
    x = np.array([_design(*key) for key in keys])
    y = np.array([posterior[v] for _, v, _ in keys])
    n = np.array([histogram[k] for k in keys], dtype=np.float64)
    n = n / n.sum() * min(n.sum(), 1000.0)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - ridge * w
        hessian = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    k, votes_end = 1 + len(LEARNED_KINDS), 1 + len(LEARNED_KINDS) + 2 * len(LABELERS)
    rest = [round(float(v), 9) for v in w]
    pairs, buckets = rest[k:votes_end], rest[votes_end:]
    return Model(rest[0], tuple(rest[1:k]), tuple(zip(pairs[::2], pairs[1::2])),
                 tuple(tuple(buckets[i:i + BUCKETS]) for i in range(0, len(buckets), BUCKETS)), tuple(map(tuple, right.round(6).tolist())))


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Learn reliabilities and the span classifier from the candidates of all rows."""
    text = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seen = [F.coalesce(F.transform(_candidates(F.col("text"), kind), _seen(k)), F.array().cast("array<struct<kind:int,votes:array<int>,features:array<int>>>"))
            for k, kind in enumerate(LEARNED_KINDS)]
    exploded = text.select(F.concat(*seen).alias("all")).select(F.explode("all").alias("x")).select("x.kind", "x.votes", "x.features")
    # At most kinds * 3 ** labelers * BUCKETS ** features rows, whatever the corpus.
    counts = exploded.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")).collect()
    return train({(r["kind"], tuple(r["votes"]), tuple(r["features"])): r["n"] for r in counts})


def _seen(k: int):
    return lambda c: F.struct(F.lit(k).alias("kind"), c["votes"].alias("votes"), c["features"].alias("features"))


def _accepted(cands: Column, kind: int, model: Model) -> Column:
    def logit(c):
        score = F.lit(model.bias + model.kind[kind])
        for k, (against, for_) in enumerate(model.weights):
            vote = F.element_at(c["votes"], k + 1)
            score = score + F.when(vote == 0, against).when(vote == 1, for_).otherwise(0.0)
        for k, buckets in enumerate(model.features):
            score = score + F.element_at(F.array(*[F.lit(w) for w in buckets]), F.element_at(c["features"], k + 1) + 1)
        return score

    none = F.array().cast("array<struct<start:int,end:int>>")
    kept = F.filter(cands, lambda c: logit(c) >= 0)
    return F.coalesce(F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))), none)


def span_columns(text: Column, model: Model) -> dict[str, Column]:
    """Array of (start, end) per kind, base kinds first."""
    columns = {kind: _kept(find(text, pattern), check) for kind, (pattern, check) in _CHECKS.items()}
    for k, kind in enumerate(LEARNED_KINDS):
        columns[kind] = _accepted(_candidates(text, kind), k, model)
    return columns


def _written(kind: str) -> Column:
    return F.transform(F.col(f"_{kind}"), lambda x: F.concat_ws(
        ":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds, digest of the base spans, all spans as text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", *[c.alias(f"_{k}") for k, c in span_columns(F.col("text"), model).items()])
    joined = lambda kinds: F.array_join(F.concat(*[_written(k) for k in kinds]), ",")
    return rows.select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                       F.sha2(joined(BASE_KINDS), 256).alias("base_sha256"),
                       joined(BASE_KINDS + LEARNED_KINDS).alias("spans"))


def _tagged(kind: str) -> Column:
    return F.transform(F.col(f"_{kind}"), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("tag")))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind; null texts stay null."""
    kinds = BASE_KINDS + LEARNED_KINDS
    taken = {f"_{k}" for k in kinds} | {"_spans", "_reach", "_slices"}
    clash = taken & {c.lower() for c in docs.columns}
    keep = {c: f"_in{i}" for i, c in enumerate(docs.columns)} if clash else {c: c for c in docs.columns}
    rows = docs.toDF(*keep.values())
    text = F.col(keep[text_col])
    rows = rows.select("*", *[c.alias(f"_{k}") for k, c in span_columns(F.coalesce(text, F.lit("")), model).items()])
    rows = rows.select(*keep.values(), F.array_sort(F.concat(*[_tagged(k) for k in kinds])).alias("_spans"))
    # How far the spans up to each one reach, and the text in slices, from which a piece is cut without counting from the start.
    reach = _running(F.transform("_spans", lambda x: x["end"]), lambda x, y: F.greatest(x, y))
    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_SLICE}}}"), F.lit(0))
    any_span = text.isNotNull() & (F.size("_spans") > 0)
    rows = rows.select("*", F.when(any_span, reach).alias("_reach"), F.when(any_span, slices).alias("_slices"))

    def cut(start: Column, end: Column) -> Column:
        first, last = F.floor(start / _SLICE).cast("int"), F.floor(end / _SLICE).cast("int")
        one = lambda k: F.coalesce(F.get("_slices", k), F.lit(""))
        inside = F.substring(one(first), start % _SLICE + 1, end - start)
        across = F.concat(F.substring(one(first), start % _SLICE + 1, F.lit(_SLICE)),
                          F.array_join(F.slice("_slices", first + 2, last - first - 1), ""), F.substring(one(last), F.lit(1), end % _SLICE))
        return F.when(first == last, inside).otherwise(across)

    def piece(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get("_reach", i - 1), F.lit(0))
        return F.when(x["start"] >= before, F.concat(cut(before, x["start"]), x["tag"])).otherwise(F.lit(""))

    masked = F.concat(F.array_join(F.transform("_spans", piece), ""), cut(F.element_at("_reach", -1), F.length(text)))
    new_text = F.when(any_span, masked).otherwise(text)
    return rows.select(*[(new_text if c == text_col else F.col(k)).alias(c) for c, k in keep.items()])
