"""Personal data by weak supervision (operator 2).

1. Every text is scanned for *candidates*: all spans of the base rules (email,
   ip, card, phone) and of wider patterns (numbers that fail the card checksum,
   national phone numbers, spelled-out addresses).
2. Labelers vote on each candidate: the base rule itself, a gazetteer (top-level
   domains, card issuers, dialling codes), the words before it, its grouping and
   its borders. A vote is for, against, or none.
3. Expectation-maximisation (conditionally independent labelers, per kind)
   estimates how reliable each labeler is and the posterior of each pattern of
   votes. It reads the histogram of vote patterns over the whole corpus, which
   Spark counts and whose size is bounded by the number of patterns.
4. A logistic span classifier per kind is trained on those posteriors, from
   votes and shape features, and decides about every candidate.

Spans of the base rules always stay; the classifier adds spans. Both passes run
beside the scan; only histogram rows are shuffled.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, bound_batches, release_tables, text_pieces, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "gazetteer", "context", "grouping", "border")

_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = re.compile(_LOCAL + r"++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_START = re.compile(r"(?<!" + _LOCAL + r")" + _EMAIL.pattern)
_EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*")
# from inside a run of digits no match begins that would not begin at its start
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# every place where a card number may begin, also inside a longer run of groups
_CARD_GROUPS = re.compile(r"(?<![0-9])(?=((?:[0-9]{4}([ -]?)[0-9]{4}\2[0-9]{4}\2[0-9]{2,7}|3[47][0-9]{2}([ -]?)[0-9]{6}\3[0-9]{5})(?![0-9])))")
# without a country code, a run of groups that goes on with digits is no phone number
_PHONE_GROUPS = re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{2,4}[ .-][0-9]{2,5}(?![0-9])|(?<![0-9][ .-])(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{2,4}[ .-][0-9]{2,5}(?![ .-]?[0-9]))")
# spelled-out addresses: the signs (four characters each), what follows one, and what
# must stand before it. Behind a plain " at " a domain's dots are spelled out, or have
# no space around them.
_SIGNS = (" at ", "(at)", "[at]", "{at}")
_SPELLED_DOT = r"(?:\(dot\)|\[dot\]|\{dot\}| dot )"
_DOMAIN_PLAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?" + _SPELLED_DOT + r" ?)[A-Za-z0-9-]{1,63}){1,5}")
_DOMAIN_BRACKET = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|" + _SPELLED_DOT + r") ?[A-Za-z0-9-]{1,63}){1,5}")
_SPELLED_LOCAL = re.compile(r"[A-Za-z0-9][\w.%+-]{0,63}\Z", re.ASCII)

# Gazetteers and cue words.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io ai app dev eu us uk de fr es it nl be ch at se no dk fi pl cz pt ie ru ua cn jp kr in au nz ca mx br ar cl za".split())
DIALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CUES = {
    "email": "email e-mail mail contact write courriel correo kontakt adresse".split(),
    "ip": "ip host server address adresse serveur servidor from login connexion".split(),
    "card": "card visa mastercard credit debit carte karte tarjeta kreditkarte payment".split(),
    "phone": "phone tel telephone telefon call mobile fax handy cell móvil téléphone teléfono appelez llame anrufen".split(),
}
AGAINST = frozenset("version release order invoice isbn issn doi token secret password key hash sha id ref no number build serial article section page".split())

_OUT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        left = at
        while left > done and _EMAIL_RUN.fullmatch(text[left - 1]):
            left -= 1
        right = _EMAIL_RUN.match(text, at).end()
        m = _EMAIL_START.search(text, left, right) if left == 0 or not _EMAIL_RUN.fullmatch(text[left - 1]) else _EMAIL.match(text, left, right) or _EMAIL_START.search(text, left, right)
        while m:
            yield m.span()
            done = m.end()
            m = _EMAIL.match(text, done, right) or _EMAIL_START.search(text, done, right)
        done = max(done, right)
        at = text.find("@", right)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base rules, in order."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 or not p.strip("0") or len(p.lstrip("0")) <= 3 for p in m.group().split(".")) and all(int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start():
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(found)


def _spelled(text: str):
    """Spans of spelled-out addresses: around each sign, so a candidate depends on
    its own words only."""
    found = []
    for sign in _SIGNS:
        at = text.find(sign)
        while at >= 0:
            found.append((at, sign))
            at = text.find(sign, at + 1)
    done = 0
    for at, sign in sorted(found):
        if at < done:
            continue
        domain = (_DOMAIN_PLAIN if sign == " at " else _DOMAIN_BRACKET).match(text, at + 4)
        if not domain:
            continue
        end = at - 1 if sign != " at " and text[at - 1 : at] == " " else at
        local = _SPELLED_LOCAL.search(text[max(0, end - 64) : end])
        if local:
            done = domain.end()
            yield end - len(local.group()), done


def _free(span: tuple[int, int], starts: list[int], ends: list[int]) -> bool:
    """Whether a span touches none of the disjoint, ascending intervals."""
    k = bisect.bisect_left(starts, span[1])
    return k == 0 or ends[k - 1] <= span[0]


def wide_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the wider patterns that touch no base span."""
    found = [(a, 0, b) for a, b in _spelled(text)]
    if _DIGIT.search(text):
        found += [(m.start(1), 2, m.end(1)) for m in _CARD_GROUPS.finditer(text)]
        found += [(m.start(), 3, m.end()) for m in _PHONE_GROUPS.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    if not found:
        return found
    starts: list[int] = []
    ends: list[int] = []
    for a, _, b in base:  # by start; base spans of two kinds may overlap
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return [s for s in sorted(found) if _free((s[0], s[2]), starts, ends)]


def votes(text: str, span: tuple[int, int, int], is_base: bool) -> tuple[int, ...]:
    """The labelers' votes (1, -1, 0: none) on a candidate."""
    start, kind, end = span
    what = text[start:end]
    digits = "".join(c for c in what if c.isdigit())
    before = text[max(0, start - 40) : start].lower()
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", before)[-4:]
    glued = (start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_=\"'#/")) or (end < len(text) and (text[end].isalnum() or text[end] in "_/\"'"))
    if kind == 0:
        gazetteer = 1 if re.split(r"[^a-z0-9-]+", what.lower())[-1] in TOP_LEVEL else -1
        grouping = 1 if 1 <= len(re.split(r"[@ (\[{]", what)[0]) <= 64 else -1
    elif kind == 1:
        parts = [int(p) if len(p) < 9 else 256 for p in what.split(".")]
        gazetteer = 1 if 1 <= parts[0] <= 223 else -1
        grouping = 1 if len(parts) == 4 and all(str(p) == q for p, q in zip(parts, what.split("."), strict=True)) else -1
    elif kind == 2:
        gazetteer = 1 if (digits[0] in "456" and len(digits) == 16) or (digits[:2] in ("34", "37") and len(digits) == 15) else -1
        groups = [len(g) for g in re.split(r"[^0-9]+", what)]
        grouping = 1 if (len(groups) == 1 or groups in ([4, 4, 4, 4], [4, 6, 5])) and _luhn(digits) else -1
    else:
        plus = what.startswith("+")
        gazetteer = (1 if any(digits[:k] in DIALLING for k in (1, 2)) else -1) if plus else (1 if len(digits) == 10 and digits[0] in "23456789" else 0)
        grouping = 1 if re.fullmatch(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,5}){1,4}", what) else -1
    context = 1 if any(w in CUES[KINDS[kind]] for w in words) else -1 if any(w in AGAINST for w in words) or before.rstrip().endswith("=") else 0
    return (1 if is_base else -1, gazetteer, context, grouping, -1 if glued else 1)


def shape_bits(text: str, span: tuple[int, int, int]) -> tuple[int, ...]:
    """Further features of the classifier: length class and separators."""
    what = text[span[0] : span[2]]
    n = sum(c.isdigit() for c in what)
    return (int(n in (10, 11)), int(n in (15, 16)), int(" " in what), int("-" in what), int("." in what), int("(" in what))


#: What is known of the labelers beforehand, as P(-1), P(0), P(1) of a false and
#: of a true candidate, each worth PRIOR_WEIGHT candidates: they do better than
#: chance, and the rule misses more than it invents. It names the classes, and
#: holds where a kind has few candidates or none that are false.
PRIOR_WEIGHT = 20.0
PRIOR = np.array([[[0.97, 0.02, 0.01], [0.5, 0.2, 0.3], [0.3, 0.65, 0.05], [0.75, 0.05, 0.2], [0.6, 0.0, 0.4]], [[0.3, 0.0, 0.7], [0.1, 0.2, 0.7], [0.02, 0.68, 0.3], [0.05, 0.05, 0.9], [0.05, 0.0, 0.95]]])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1): the share of true candidates,
    the table P(vote | class) as (class, labeler, vote + 1), and the posterior of
    each pattern."""
    share, table = 0.5, np.maximum(PRIOR, 1e-3)
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        at = patterns + 1
        ll = [np.log(table[c, np.arange(patterns.shape[1]), at]).sum(axis=1) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(ll[0] + np.log(1 - share) - ll[1] - np.log(share), -60, 60)))
        moved, post = np.abs(new - post).max(initial=0), new
        share = float((post @ counts + PRIOR_WEIGHT / 2) / (counts.sum() + PRIOR_WEIGHT))
        table = np.maximum(PRIOR, 1e-3) * PRIOR_WEIGHT
        for c, weight in ((0, (1 - post) * counts), (1, post * counts)):
            for v in (-1, 0, 1):
                table[c, :, v + 1] += weight @ (patterns == v)
        table /= table.sum(axis=2, keepdims=True)
        if moved < 1e-9:
            break
    return share, table, post


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30, ridge: float = 0.02) -> np.ndarray:
    """Weighted ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class SpanModel:
    """Per kind: classifier weights, and what EM found about the labelers."""

    weights: tuple
    labelers: tuple

    def margin(self, kind: int, features: tuple[int, ...]) -> float:
        """Log odds of a candidate; without a classifier, it is rejected."""
        w = self.weights[kind]
        return -1.0 if w is None else float(np.dot(w[:-1], features) + w[-1])


def fit_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanModel:
    """Counts vote and shape patterns over all texts and trains the classifiers.
    A kind without candidates gets no classifier (nothing is added for it)."""
    out = pa.schema([("kind", pa.int32()), ("pattern", pa.list_(pa.int32())), ("n", pa.int64())])

    def count(batches):
        release_tables()
        seen: Counter = Counter()
        for _, texts in text_pieces(batches):
            for t in texts:
                base = base_spans(t)
                for s, own in [*((s, True) for s in base), *((s, False) for s in wide_spans(t, base))]:
                    seen[s[1], (*votes(t, s, own), *shape_bits(t, s))] += 1
        keys = list(seen)
        yield batch_of(out, kind=[k for k, _ in keys], pattern=[list(p) for _, p in keys], n=[seen[k] for k in keys])

    rows = texts_of(docs, id_col, text_col).mapInArrow(count, "kind int, pattern array<int>, n long").groupBy("kind", "pattern").agg(F.sum("n").alias("n")).collect()
    weights, labelers = [], []
    for kind in range(len(KINDS)):
        own = sorted((tuple(r["pattern"]), r["n"]) for r in rows if r["kind"] == kind)
        if not own:
            weights.append(None)
            labelers.append(None)
            continue
        x = np.array([p for p, _ in own], dtype=np.int64)
        n = np.array([c for _, c in own], dtype=np.float64)
        share, table, post = reliabilities(x[:, : len(LABELERS)], n)
        weights.append(fit_logistic(x.astype(float), post, n))
        labelers.append((share, table))
    return SpanModel(tuple(weights), tuple(labelers))


def all_spans(text: str, model: SpanModel) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and those that the classifier adds (touching none of them
    nor each other)."""
    base = base_spans(text)
    found = [(model.margin(s[1], (*votes(text, s, False), *shape_bits(text, s))), s) for s in wide_spans(text, base)]
    added: list[tuple[int, int, int]] = []
    starts: list[int] = []
    ends: list[int] = []
    for _, s in sorted((-m, s) for m, s in found if m > 0):  # the surest of those that overlap
        if _free((s[0], s[2]), starts, ends):
            k = bisect.bisect_left(starts, s[0])
            starts.insert(k, s[0])
            ends.insert(k, s[2])
            added.append(s)
    return base, sorted(added)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_pii(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, counts and sha256 of the base spans, all
    spans as kind:start:end, and how many were added.

    Null or empty text: no spans, the sha256 of the empty string. Repeated rows
    and null ids stay; an empty table gives an empty result; extra columns are
    not read.
    """

    def run(batches):
        release_tables()
        for ids, texts in text_pieces(batches):
            cols: dict[str, list] = {f.name: [] for f in _OUT if f.name != "doc_id"}
            for t in texts:
                base, added = all_spans(t, model)
                for k, kind in enumerate(KINDS):
                    cols[f"n_{kind}"].append(sum(s[1] == k for s in base))
                cols["base_sha256"].append(hashlib.sha256(_written(base).encode()).hexdigest())
                cols["spans"].append(_written([*base, *added]))
                cols["n_added"].append(len(added))
            yield batch_of(_OUT, doc_id=ids, **cols)

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long")


def redacted(text: str, model: SpanModel) -> str:
    """The text with every span replaced by its kind in brackets."""
    base, added = all_spans(text, model)
    out, done = [], 0
    for a, k, b in sorted([*base, *added]):
        if b > done:
            out += [text[done:a] if a >= done else "", f"[{KINDS[k].upper()}]" if a >= done else ""]
            done = b
    return "".join([*out, text[done:]])


def redact_pii(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col``; other columns and
    null texts stay as they are."""

    def run(batches):
        release_tables()
        for b in batches:
            at = b.schema.get_field_index(text_col)
            new = [None if t is None else redacted(t, model) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(new, type=b.schema.field(at).type))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
