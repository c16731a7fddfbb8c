"""Personal data by candidate gradient boosting (operator 9).

Base patterns report addresses of mail and machines, card and phone numbers.
Beyond them, generators with high recall propose overlapping spans; boosted
trees over format and context features, trained here on a bounded sample of
the documents, score them; a calibrated threshold selects those to add.

Training labels stand for what the base patterns miss: their findings in the
sampled texts are rewritten in forms that no base pattern matches (spelt-out
signs, a phone number without '+', other separators, codes with check digits).
A candidate that covers such a span is positive, as is one whose check digits
are right; rewritten spans with wrong check digits and other candidates are
negative.  Candidates that overlap a base span are not learnt from, since they
are never added.  Half of the sample's documents grow the trees, the other half
calibrates their scores and sets the threshold.

Defined cases: a null text counts as empty and has no spans; text of any
length is scanned whole; rows repeat as they are; a sample without positive
or without negative candidates adds nothing to the base spans; an empty table
gives an empty result; other columns are ignored.  Spans are code points, end
exclusive.
"""

from __future__ import annotations

import bisect
import dataclasses
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import prepare, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("mailbox", "number", "code")
KINDS = (*BASE_KINDS, *ADDED_KINDS)       # order of spans

# patterns of the base kinds (fixed values)
# email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, in two parts about the sign
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits that fails from its start fails from all its places
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

# generators of candidates
_GENERATORS = {
    "mailbox": re.compile(r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\sat\s)\s?[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[\w-]{1,63}){1,4}", re.ASCII),
    "number": re.compile(r"\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,24}"),
    "code": re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,3}[0-9]{2}(?:\x20?[A-Z0-9]{2,5}){2,8}(?![A-Za-z0-9])"),
}
# a text without any of these has no span of the kind (linear-time prefilters)
_MAY = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){15}",
        "phone": r"\+[0-9]", "mailbox": r"@|\(at\)|\[at\]| at ", "number": r"[0-9](?:[ ().\-/]{0,2}[0-9]){6}",
        "code": r"[A-Z][0-9]{2} ?[A-Z0-9]"}
# words before a span that speak of it
_CONTEXT = [("phone", re.compile(r"\b(?:phone|tel|mobile|call|fax|cell|whatsapp)\b", re.I)),
            ("mail", re.compile(r"\b(?:e-?mail|contact|write|reach)\b", re.I)),
            ("card", re.compile(r"\b(?:card|visa|account|iban|payment)\b", re.I)),
            ("host", re.compile(r"\b(?:ip|host|server|address|login)\b", re.I)),
            ("name", re.compile(r"\b(?:mr|mrs|ms|dr|name|passport|license|id)\b", re.I))]
CONTEXT_CHARS = 32

MAX_DOCS = 4000          # documents that are learnt from, on average
MAX_ROWS = 60_000        # candidates that are learnt from, at most
PRECISION = 0.98         # what calibration must show above the threshold


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _emails(text: str):
    """Leftmost matches of the email pattern in linear time: a match holds one "@", which
    is the first after its start, so each sign is looked at once, backwards to the last match."""
    last, sign = 0, text.find("@")
    while sign >= 0:
        a = sign
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        host = _HOST.match(text, sign + 1) if a < sign else None
        if host:
            yield a, host.end()
            last = host.end()
        else:
            last = sign + 1
        sign = text.find("@", last)


def base_spans(text: str, may=lambda kind: True) -> list[tuple[str, int, int]]:
    out = []
    if may("email"):
        out += [("email", a, z) for a, z in _emails(text)]
    if may("ip"):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    if may("card"):
        out += [("card", *m.span()) for m in _CARD.finditer(text)
                if CARD_DIGITS[0] <= len(d := _digits(m[0])) <= CARD_DIGITS[1] and luhn(d)]
    if may("phone"):
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return out


def candidates(text: str, may=lambda kind: True) -> list[tuple[str, int, int]]:
    return [(kind, *m.span()) for kind, p in _GENERATORS.items() if may(kind) for m in p.finditer(text)]


def check97(s: str) -> bool:
    """Whether the code's two check digits are right (ISO 7064, as in an IBAN)."""
    flat = re.sub(r"[^A-Z0-9]", "", s)
    return len(flat) >= 15 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


_CHECKED = {"number": lambda s: CARD_DIGITS[0] <= len(d := _digits(s)) <= CARD_DIGITS[1] and luhn(d), "code": check97}
# candidates of the text itself that may well be right, though nothing confirms it
_UNSURE = {"mailbox": re.compile(r"@|[(\[](?:at|dot)[)\]]"), "number": re.compile(r"[+(]")}
_MAILS = [(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot ")]


def disguised(kind: str, s: str) -> tuple[str, bool] | None:
    """A base span in a form that no base pattern matches, and whether it is
    personal data still (its check digits may be made wrong)."""
    pick, d = zlib.crc32(s.encode()), _digits(s)
    if kind == "email":
        at, dot = _MAILS[pick % 3]
        name, host = s.rsplit("@", 1)
        return name + at + host.replace(".", dot), True
    if kind == "phone" and pick % 6 < 4:
        return (s[1:], f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}")[pick % 2 and len(d) >= 10], True
    if kind == "card" and pick % 4 < 2:
        d = d if pick % 2 else d[:-1] + str((int(d[-1]) + 1) % 10)
        return ".".join(d[i:i + 4] for i in range(0, len(d), 4)), bool(pick % 2)
    if kind in ("phone", "card"):
        body = d.rjust(18, "0")[-18:]
        check = 98 - int(body + "131400") % 97
        check = check if pick % 2 else check % 97 + 1      # DE is 1314
        code = f"DE{check:02d}{body}"
        return (code, " ".join(code[i:i + 4] for i in range(0, 22, 4)))[pick // 12 % 2], check97(code)
    return None


def lessons(text: str, may=lambda kind: True) -> list[tuple[list[float], bool]]:
    """(features, label) of the candidates of a text and of its disguised form."""
    own = base_spans(text, may)
    busy = IntervalSet((a, z) for _, a, z in own)
    out = []
    for kind, a, z in candidates(text, may):
        if not busy.meets(a, z):
            checked = kind in _CHECKED and _CHECKED[kind](text[a:z])
            if checked or kind not in _UNSURE or not _UNSURE[kind].search(text[a:z]):
                out.append((features(text, kind, a, z), checked))
    parts, planted, last, size = [], [], 0, 0
    for kind, s, e in sorted(own, key=lambda c: (c[1], -c[2])):
        if s >= last and (new := disguised(kind, text[s:e])):
            parts += [text[last:s], new[0]]
            size += s - last
            planted.append((size, size + len(new[0]), new[1]))
            size += len(new[0])
            last = e
    if planted:
        other = "".join([*parts, text[last:]])
        busy = IntervalSet((a, z) for _, a, z in base_spans(other))
        starts = [p[0] for p in planted]
        for kind, a, z in candidates(other):
            i = bisect.bisect_right(starts, a + 4) - 1
            # about the whole span: what only shares a part of it teaches nothing
            if i >= 0 and a <= planted[i][0] and planted[i][1] <= z <= planted[i][1] + 4 and not busy.meets(a, z):
                out.append((features(other, kind, a, z), planted[i][2]))
    return out


FEATURES = ["mailbox", "number", "code", "chars", "digits", "letters", "groups", "widest", "blanks", "dots", "dashes",
            "brackets", "plus", "at", "luhn", "ip", "check97", "last_label", "upper", "left_word", "right_word",
            "line_start", "line_end", *(f"near_{name}" for name, _ in _CONTEXT)]


def features(text: str, kind: str, a: int, z: int) -> list[float]:
    """Format of the span and what stands around it."""
    s = text[a:z]
    d = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    before = text[max(0, a - CONTEXT_CHARS):a]
    label = re.split(r"[.\s]+", s)[-1]
    return [kind == "mailbox", kind == "number", kind == "code", len(s), len(d), sum(c.isalpha() for c in s),
            len(groups), max(map(len, groups), default=0), s.count(" "), s.count("."), s.count("-"),
            s.count("(") + s.count(")"), s.startswith("+"), "@" in s, luhn(d) if len(d) > 7 else False,
            len(groups) == 4 and s.count(".") == 3 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
            kind == "code" and check97(s),
            len(label) if label.isalpha() else 0, sum(c.isupper() for c in s),
            text[a - 1:a].isalnum(), text[z:z + 1].isalnum(), a == 0 or text[a - 1] == "\n",
            z == len(text) or text[z] == "\n", *(bool(p.search(before)) for _, p in _CONTEXT)]


# ------------------------------------------------------------ boosted trees

@dataclasses.dataclass
class Trees:
    """Boosted trees of one depth: a feature and a cut for each inner node, a
    value for each leaf, and the score-to-probability steps of the calibration."""

    feature: np.ndarray     # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray       # trees x leaves
    start: float
    steps: np.ndarray       # scores at which the calibrated probability rises
    chances: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.value.shape[1]))
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (v.shape[0] - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.steps, self.raw(x), side="right") - 1
        return self.chances[np.maximum(at, 0)]


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2,
         smooth: float = 1.0) -> Trees:
    """Newton boosting of logistic loss over quantile bins."""
    bins = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
    coded = np.stack([np.searchsorted(b, x[:, j], side="left") for j, b in enumerate(bins)], axis=1)
    width = max(len(b) for b in bins) + 1
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    score = np.full(len(y), np.log(share / (1 - share)))
    start, inner = float(score[0]), (1 << depth) - 1
    feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            for n in range((1 << level) - 1, (1 << (level + 1)) - 1):
                own = node == n
                if own.any():
                    best = 1e-6
                    for j, b in enumerate(bins):
                        gs = np.cumsum(np.bincount(coded[own, j], g[own], width))
                        hs = np.cumsum(np.bincount(coded[own, j], h[own], width))
                        gain = (gs ** 2 / (hs + smooth) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + smooth)
                                - gs[-1] ** 2 / (hs[-1] + smooth))[:len(b)]
                        if len(gain) and gain.max() > best:
                            best = gain.max()
                            feature[t, n], cut[t, n] = j, b[int(gain.argmax())]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + smooth)
        score += value[t, leaf]
    return Trees(feature, cut, value, start, np.array([-np.inf]), np.array([0.0]), np.inf)


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> Trees:
    """Isotonic steps from scores to probabilities; the threshold is the lowest
    probability at and above which held-back candidates are right often enough."""
    raw = model.raw(x)
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []            # [lowest score, positives, rows]
    for s, label in zip(raw[order].tolist(), y[order].tolist()):
        if blocks and blocks[-1][0] == s:
            blocks[-1][1] += label
            blocks[-1][2] += 1
        else:
            blocks.append([s, label, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
    steps = np.array([b[0] for b in blocks])
    chances = np.array([b[1] / b[2] for b in blocks])
    hits = np.cumsum([b[1] for b in blocks][::-1])
    rows = np.cumsum([b[2] for b in blocks][::-1])
    good = np.flatnonzero(hits / rows >= precision)
    threshold = float(chances[::-1][good[-1]]) if len(good) else np.inf
    return dataclasses.replace(model, steps=steps, chances=chances, threshold=threshold)


def _prefilter(column) -> dict[str, list[bool]]:
    return {k: pc.match_substring_regex(column, p).to_pylist() for k, p in _MAY.items()}


def _batch_texts(b: pa.RecordBatch):
    """(row, text or None, allowed kinds): None where no pattern can match."""
    may = _prefilter(b.column(1))
    for i in range(b.num_rows):
        if any(v[i] for v in may.values()):
            yield i, b.column(1)[i].as_py(), lambda kind, i=i: may[kind][i]
        else:
            yield i, None, None


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS,
          max_rows: int = MAX_ROWS) -> Trees | None:
    """Trees from the candidates of about ``max_docs`` documents, chosen by hash."""
    base = texts(docs, id_col, text_col)
    share = int(min(1.0, max_docs / max(1, base.count())) * (1 << 20))
    chosen = base.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share)

    def propose(batches):
        for b in batches:
            rows, labels, part = [], [], []
            for i, text, may in _batch_texts(b):
                if text is None:
                    continue
                half = hash_half(text)
                for row, label in lessons(text, may):
                    rows.append(row)
                    labels.append(label)
                    part.append(half)
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.asarray(r, np.float64) for r in rows], pa.list_(pa.float64())),
                 pa.array(labels, pa.bool_()), pa.array(part, pa.bool_())], ["x", "y", "half"])

    # beyond max_rows the hash of a lesson decides, so the same lessons train every time
    got = (chosen.mapInArrow(propose, "x array<double>, y boolean, half boolean")
           .orderBy(F.xxhash64("x", "y", "half"), "x").limit(max_rows).collect())
    if not got:
        return None
    x, y = np.array([r["x"] for r in got], np.float64), np.array([r["y"] for r in got], np.float64)
    half = np.array([r["half"] for r in got])
    if len({*y[half]}) < 2 or len({*y[~half]}) < 2:
        return None
    return calibrate(grow(x[half], y[half]), x[~half], y[~half])


def hash_half(text: str) -> bool:
    return zlib.crc32(text.encode()) % 2 == 0


def select(model: Trees | None, text: str, own: list[tuple[str, int, int]],
           may=lambda kind: True) -> list[tuple[str, int, int]]:
    """Candidates above the threshold, best first, that overlap no base span and
    no better candidate."""
    found = candidates(text, may) if model is not None else []
    if not found:
        return []
    p = model.probability(np.array([features(text, *c) for c in found], np.float64))
    good = [(q, c) for q, c in zip(p.tolist(), found) if q >= model.threshold]
    busy = IntervalSet((a, z) for _, a, z in own)
    out = []
    for _, c in sorted(good, key=lambda r: (-r[0], r[1][1] - r[1][2], r[1][1])):
        if busy.add(c[1], c[2]):
            out.append(c)
    return out


class IntervalSet:
    """Disjoint intervals, merged at first; ``add`` refuses an overlapping one."""

    def __init__(self, spans):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, z in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], z)
            else:
                self.starts.append(a)
                self.ends.append(z)

    def meets(self, a: int, z: int) -> bool:
        i = bisect.bisect_left(self.ends, a + 1)
        return i < len(self.starts) and self.starts[i] < z

    def add(self, a: int, z: int) -> bool:
        if self.meets(a, z):
            return False
        i = bisect.bisect_left(self.ends, a + 1)
        self.starts.insert(i, a)
        self.ends.insert(i, z)
        return True


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, base array<struct<kind,start,end>>, spans the same with the selected ones)."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, id_col, text_col, max_docs))
    base = texts(docs, id_col, text_col)

    def run(batches):
        trees = model.value
        for b in batches:
            own, every = [], []
            for _, text, may in _batch_texts(b):
                found = base_spans(text, may) if text else []
                own.append(ordered(found))
                every.append(ordered(found + select(trees, text, found, may)) if text else [])
            as_rows = lambda spans: pa.array(
                [[{"kind": k, "start": a, "end": z} for k, a, z in s] for s in spans], _SPAN)
            yield pa.RecordBatch.from_arrays([b.column(0), as_rows(own), as_rows(every)], ["doc_id", "base", "spans"])

    kind = base.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return base.mapInArrow(run, f"doc_id {kind}, base {span}, spans {span}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, last = [], 0
    for kind, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"<{kind}>"]
            last = z
    return "".join([*out, text[last:]])
