"""Personal data by fixed patterns and a semi-Markov conditional random field.

The fixed patterns find the usual forms. The field finds forms that they do not know (an address
with ``(at)``, a number without ``+``): a window around each digit or sign (``@``, a bracketed ``at`` or dot, ``at`` before a
dotted name, the word ``dot``) is cut into tokens; runs of up
to ``LONGEST`` tokens are candidate segments; features of the whole segment (digit groups, checksum,
separators, ends, words before) score it under each kind, and dynamic programming over segment
boundaries picks the best set of segments and kinds together. A candidate holds a digit or sign, so outside
the windows none exists and the best labelling there is plain text.

The field is trained on the distinct windows of the whole corpus: spans of the fixed patterns and rewritten
forms of them are its positive segments; spans that fail a check and all other numbers are not. Windows are
dealt by hash to shards of bounded size, a task trains a field on each, and a weight of the whole is the mean
over the shards that met its feature. Features are hashed to ``SLOTS`` numbers, which bounds the weights.
"""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairstats.llm.common import map_texts, texts_of
from pairstats.sinks.stage import materialize

KINDS = ("email", "ip", "card", "phone")
#: Windows of a shard, by expectation, and passes over them.
SHARD, EPOCHS = 4000, 3
#: Numbers that features are hashed to.
SLOTS = 2**16
#: Slots of the constant feature and of none.
_CONSTANT, _NONE = SLOTS, SLOTS + 1
#: Tokens in a segment, and characters beside a sign that a window takes in.
LONGEST, BESIDE = 28, 48
#: A segment is added where it beats plain text by so much.
MARGIN = 1.0

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Starting inside a run of digits never finds what its start does not.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|[^\sA-Za-z0-9]")
#: Rewritten signs of an address: a bracketed at or dot, at before a dotted name.
_REWRITTEN = r"[\[({]\s?at\s?[\])}]|[\[({]\.[\])}]|(?<=\s)at(?=\s[A-Za-z0-9-]{1,63}\.[A-Za-z0-9])"
_SIGN = re.compile(rf"[0-9]+|@|\bdot\b|{_REWRITTEN}", re.I | re.A)
_ELSE = re.compile(_REWRITTEN, re.I | re.A)
_LETTERS, _DIGITS, _PLAIN = re.compile(r"[a-z]+"), re.compile(r"[0-9]+"), re.compile(r"[a-z0-9]")
_SIGNS = re.compile(r"[\[({ ]+(?:at|dot)[\])} ]+|[\[({]\.[\])}]")
_AT = re.compile(r"@|[\[({]\s?at\s?[\])}]| at ")
_DOT = re.compile(r"[\[({]\s?dot\s?[\])}]| dot |[\[({]\.[\])}]")
_ONE_LOCAL = re.compile(r"[a-z0-9._%+-]+")
_ONE_DOMAIN = re.compile(
    r"[a-z0-9-]+(?:(?:\.| dot |\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?)[a-z0-9-]+)+"
)
_TOP = frozenset(("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"))
_CUES = {
    "email": frozenset(("mail", "email", "contact", "write", "e")),
    "ip": frozenset(("ip", "host", "server", "address", "addr")),
    "card": frozenset(("card", "visa", "mastercard", "credit", "pan", "payment")),
    "phone": frozenset(("phone", "tel", "call", "fax", "mobile", "telephone", "cell")),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (d * 2 - 9 if d > 4 else d * 2) if k % 2 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _at_most_255(digits: str) -> bool:
    """Of any number of digits: a long run of them is never made a number."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start; linear in the text."""
    found = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(_at_most_255(p) for p in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 16:
                continue
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 8 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


def windows(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Places around digits and signs that no span covers; close ones are joined."""
    covered = sorted((a, b) for _, a, b in taken)
    out: list[tuple[int, int]] = []
    k, reach = 0, -1
    for m in _SIGN.finditer(text):
        while k < len(covered) and covered[k][0] <= m.start():
            reach = max(reach, covered[k][1])
            k += 1
        if m.start() < reach:
            continue
        a, b = max(0, m.start() - BESIDE), min(len(text), m.end() + BESIDE)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _tokens(part: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(part)]


def candidates(part: str, tokens: list[tuple[int, int]]):
    """(first token, token after the last, slots of features) of the segments that may be personal data, by first token."""
    n = len(tokens)
    for i in range(n):
        a = tokens[i][0]
        first = part[a]
        if not (first.isalnum() or first in "+("):
            continue
        if a and (part[a - 1].isalnum() or part[a - 1] in "@+._%-"):
            continue
        cues = None
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            b = tokens[j - 1][1]
            if part[b - 1] == "\n":
                break
            if not part[b - 1].isalnum() or (b < len(part) and part[b].isalnum()):
                continue
            s = part[a:b]
            if not (_DIGIT.search(s) or "@" in s or "dot" in s.lower() or _ELSE.search(s)):
                continue
            cues = _cues(part, a) if cues is None else cues
            yield i, j, features(s) + cues


def _slots(names: list[str]) -> tuple[int, ...]:
    return tuple([zlib.crc32(x.encode("utf-8", "surrogatepass")) % SLOTS for x in names])


def _cues(part: str, a: int) -> tuple[int, ...]:
    """Slots of the words before a segment."""
    before = set(_LETTERS.findall(part[max(0, a - 24) : a].lower())[-2:])
    return _slots(["cue " + kind for kind, words in _CUES.items() if words & before])


def features(s: str) -> tuple[int, ...]:
    """Slots of the whole segment's features."""
    low = s.lower()
    groups = _DIGITS.findall(s)
    lengths = [len(g) for g in groups]
    total = sum(lengths)
    signs = "at" in low or "dot" in low or any(x in low for x in (".]", ".)", ".}"))
    plain = _SIGNS.sub("", low) if signs else low
    out = [
        "groups=" + ",".join(map(str, lengths)) if len(groups) <= 5 else "groups=many",
        "digits=" + ("0" if not total else "1-6" if total < 7 else "7-15" if total < 16 else "16-19"
                     if total < 20 else "more"),
        "gap=" + "".join(sorted(set(_PLAIN.sub("", plain)))),
        "letters" if _LETTERS.search(plain) else "no letters",
        "begins " + ("+" if s[0] == "+" else "(" if s[0] == "(" else "0" if s[0].isdigit() else "a"),
    ]
    if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        out.append("octets")
    if 16 <= total <= 19:
        out.append("checksum" if luhn("".join(groups)) else "no checksum")
    at = _AT.search(low) if signs or "@" in low else None
    if at:
        out.append("at " + at.group().strip(" ()[]{}"))
        local, domain = low[: at.start()].strip(), low[at.end() :].strip()
        out.append("one local" if _ONE_LOCAL.fullmatch(local) else "bad local")
        out.append("one domain" if _ONE_DOMAIN.fullmatch(domain) else "bad domain")
        out.append("top" if re.split(r"[^a-z]", low)[-1] in _TOP else "no top")
    if signs and _DOT.search(low):
        out.append("dot")
    out.append("long" if len(s) > 45 else "short")
    return _slots(out)


def decode(part: str, weights: dict) -> list[tuple[str, int, int, float]]:
    """The best segmentation of a window: (kind, start, end, lead over plain text).

    Of equal ones plain text comes first, then the earlier start, then the kind as listed. Segments are scored
    as they come, so that a long window holds none of them.
    """
    tokens = _tokens(part)
    none = (0.0,) * len(KINDS)
    constant = weights.get(_CONSTANT, none)
    best: list[float] = [0.0] + [-math.inf] * len(tokens)
    back: list = [None] * (len(tokens) + 1)
    settled = 0
    for i, j, slots in candidates(part, tokens):
        while settled < i:
            settled += 1
            if best[settled - 1] >= best[settled]:
                best[settled], back[settled] = best[settled - 1], None
        rows = [weights.get(x, none) for x in slots]
        for k, kind in enumerate(KINDS):
            s = constant[k] + sum(row[k] for row in rows)
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, kind, s)
    for j in range(settled + 1, len(tokens) + 1):
        if best[j - 1] >= best[j]:
            best[j], back[j] = best[j - 1], None
    out, j = [], len(tokens)
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, kind, s = back[j]
            out.append((kind, tokens[i][0], tokens[j - 1][1], s))
            j = i
    return out[::-1]


class _Window:
    """A window made ready for training: its segments, their slots and which of them are true."""

    def __init__(self, part: str, gold: set[tuple[str, int, int]]):
        tokens = _tokens(part)
        found = list(candidates(part, tokens))
        self.tokens = len(tokens)
        self.first = np.array([c[0] for c in found], dtype=np.int32)
        self.last = np.array([c[1] for c in found], dtype=np.int32)
        widest = max((len(c[2]) for c in found), default=0) + 1
        slots = np.full((len(found), widest), _NONE, dtype=np.int32)
        for row, c in zip(slots, found, strict=True):
            row[: len(c[2]) + 1] = [_CONSTANT, *c[2]]
        self.slots, place = np.unique(slots, return_inverse=True)
        self.place = place.reshape(slots.shape).astype(np.int32)
        self.gold = np.array(
            [[(k, tokens[i][0], tokens[j - 1][1]) in gold for k in KINDS] for i, j, _ in found], dtype=float
        ).reshape(len(found), len(KINDS))


def _shares(window: _Window, scores: np.ndarray) -> tuple[np.ndarray, float]:
    """Probability of each segment under each kind, by forward and backward sums, and the log of all sums."""
    n = window.tokens
    whole = np.logaddexp.reduce(scores, axis=1).tolist()
    ends: list[list] = [[] for _ in range(n + 1)]
    starts: list[list] = [[] for _ in range(n + 1)]
    for i, j, s in zip(window.first.tolist(), window.last.tolist(), whole, strict=True):
        ends[j].append((i, s))
        starts[i].append((j, s))
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = _log_sum([ahead[j - 1], *(ahead[i] + s for i, s in ends[j])]) if ends[j] else ahead[j - 1]
    for i in range(n - 1, -1, -1):
        behind[i] = _log_sum([behind[i + 1], *(behind[j] + s for j, s in starts[i])]) if starts[i] else behind[i + 1]
    beside = np.array(ahead)[window.first] + np.array(behind)[window.last] - ahead[n]
    return np.exp(np.minimum(0.0, beside[:, None] + scores)), ahead[n]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _step(window: _Window, weights: np.ndarray, sums: np.ndarray, rate: float) -> None:
    """One step along the gradient of the log-likelihood."""
    if not len(window.first):
        return
    old = weights[:, window.slots]
    scores = old[:, window.place].sum(axis=2).T
    gap = window.gold - _shares(window, scores)[0]
    gap[np.abs(gap) < 1e-4] = 0.0
    width = window.place.shape[1]
    gradient = np.array([
        np.bincount(window.place.ravel(), np.repeat(gap[:, k], width), len(window.slots))
        for k in range(len(KINDS))
    ])
    gradient[:, window.slots == _NONE] = 0.0
    sums[:, window.slots] += gradient**2
    weights[:, window.slots] = old * (1 - 1e-4 * (gradient != 0)) + rate * gradient / np.sqrt(
        sums[:, window.slots]
    )


def _rewritten(kind: str, s: str, rng: random.Random) -> tuple[str, bool]:
    """Another form of a span, and whether it still is personal data."""
    if kind == "email":
        at, dot = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "),
                              ("(at)", "."), ("[at]", "[.]"), (" (at) ", ".")])
        local, _, domain = s.partition("@")
        return local + at + domain.replace(".", dot), True
    if kind == "ip":
        parts = s.split(".")
        if rng.random() < 0.4:
            return ".".join([*parts[:3], str(int(parts[3]) + 300)]), False
        return rng.choice(["[.]", "(.)", " dot "]).join(parts), True
    digits = _digits(s)
    if kind == "card":
        if rng.random() < 0.4:
            return digits[:-1] + str((int(digits[-1]) + 1) % 10), False
        gap = rng.choice([".", "  ", "/"])
        return gap.join(digits[k : k + 4] for k in range(0, len(digits), 4)), True
    if len(digits) < 10:
        return digits[:5], False
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}"])
    return form.format(a, b, c), True


def _other_number(rng: random.Random) -> str:
    n = lambda k: str(rng.randrange(10 ** (k - 1), 10**k))
    return rng.choice([
        lambda: f"{n(4)}-0{n(1)}-{n(2)}", lambda: f"{n(1)}.{n(1)}", lambda: f"{n(1)}.{n(1)}.{n(2)}",
        lambda: n(rng.randrange(1, 13)), lambda: f"{n(3)},{n(3)},{n(3)}", lambda: f"{n(2)}:{n(2)}",
        lambda: f"{n(2)}/{n(2)}/{n(4)}", lambda: f"{n(3)}-{n(3)}", lambda: n(40),
        lambda: f"{rng.randrange(16**12):012x}", lambda: f"{n(4)} {n(4)}", lambda: f"v{n(1)}.{n(1)}",
        lambda: f"{n(1)} dot {n(1)}", lambda: f"at {n(2)} dot",
    ])()


def training_windows(text: str, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows of a text with their true segments: spans rewritten, other numbers, and what no span covers."""
    rng = random.Random(seed)
    found = base_spans(text)
    out = []
    for kind, a, b in found:
        left, right = text[max(0, a - BESIDE) : a], text[b : b + BESIDE]
        for _ in range(2):
            s, yes = _rewritten(kind, text[a:b], rng)
            part = left + s + right
            # Other spans beside this one stay true.
            gold = [g for g in base_spans(part) if g[2] <= len(left) or g[1] >= len(left) + len(s)]
            if yes:
                gold.append((kind, len(left), len(left) + len(s)))
            out.append((part, gold))
        part = left + _other_number(rng) + right
        out.append((part, base_spans(part)))
    for a, b in windows(text, found):
        # A long window is taught in pieces.
        for x in range(a, b, 4 * BESIDE):
            part = text[x : min(b, x + 4 * BESIDE)]
            out.append((part, base_spans(part)))
    return out


def train(parts: list[tuple[str, list[tuple[str, int, int]]]]) -> dict:
    """Weights of the kinds by slot, from windows with their true segments."""
    weights = np.zeros((len(KINDS), SLOTS + 2))
    weights[:, _CONSTANT] = -2.0
    sums = np.full(weights.shape, 1e-3)
    rng = random.Random(7)
    ready = [_Window(part, {tuple(g) for g in gold}) for part, gold in parts]
    for epoch in range(EPOCHS):
        rng.shuffle(ready)
        for window in ready:
            _step(window, weights, sums, 0.6 / (1 + epoch / 2))
    met = np.unique(np.concatenate([[_CONSTANT], *(w.slots for w in ready)]))
    return {int(x): tuple(weights[:, x].round(6).tolist()) for x in met if x != _NONE}


def find_spans(text: str, weights: dict) -> tuple[list, list]:
    """(spans of the fixed patterns, spans the field adds), each by kind and start."""
    base = base_spans(text)
    added = []
    for a, b in windows(text, base) if weights else ():
        for kind, x, y, lead in decode(text[a:b], weights):
            x, y = x + a, y + a
            # At its edges a window may have cut a word.
            cut = (a and x == a) or (b < len(text) and y == b)
            if lead >= MARGIN and not cut and all(y <= c or x >= d for _, c, d in base):
                added.append((kind, x, y))
    order = {kind: k for k, kind in enumerate(KINDS)}
    by = lambda s: (order[s[0]], s[1])
    return sorted(base, key=by), sorted(added, key=by)


def _written(gold: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(gold))


def _read(gold: str) -> list[tuple[str, int, int]]:
    split = (g.split(":") for g in gold.split(",") if g)
    return [(k, int(a), int(b)) for k, a, b in split]


def fit_field(docs: DataFrame) -> dict:
    """Weights from the windows of all texts that hold digits or signs; {} if none has a span.

    A window that occurs more than once counts once. Shards grow in number with the windows, not in size, and
    what comes back to the driver is a mean for each slot: SLOTS + 1 rows at most.
    """
    texts = docs.select("text").where(F.col("text").rlike("[0-9][ .()-]?[0-9]{2}|@"))
    made = map_texts(
        texts,
        "parts array<struct<part:string,gold:string>>",
        lambda texts: [
            [[{"part": p, "gold": _written(g)} for p, g in training_windows(t, len(t))] for t in texts]
        ],
    )
    parts = made.select(F.inline("parts")).groupBy("part").agg(F.max("gold").alias("gold"))
    parts = materialize(parts, "windows")
    if parts.where("gold <> ''").isEmpty():
        return {}
    shards = -(-parts.count() // SHARD)

    def fit(shard):
        import pandas as pd

        shard = shard.sort_values("part")
        weights = train([(p, _read(g)) for p, g in zip(shard["part"], shard["gold"], strict=True)])
        return pd.DataFrame({"slot": list(weights), "weights": [list(w) for w in weights.values()]})

    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("part"), F.lit(shards)))
    fitted = dealt.groupBy("shard").applyInPandas(fit, "slot int, weights array<double>")
    means = [F.avg(F.col("weights")[k]).alias(kind) for k, kind in enumerate(KINDS)]
    rows = fitted.groupBy("slot").agg(*means).collect()
    return {r["slot"]: tuple(round(r[kind], 6) for kind in KINDS) for r in rows}


def mark_personal_data(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """``docs`` (doc_id, text, others) without text, with ``base`` and ``added``: lists of spans.

    Offsets are in code points, ends exclusive. A null or empty text has no spans; repeated rows
    and rows without id get their own. Without a span of the fixed patterns in any text there is
    no field, and nothing is added.
    """
    plain = docs.withColumn("text", F.coalesce("text", F.lit("")))
    weights = fit_field(plain) if weights is None else weights

    def mark(texts: list[str]) -> list[list]:
        both = [find_spans(t, weights) for t in texts]
        return [
            [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in side]
            for side in zip(*both, strict=True)
        ] if both else [[], []]

    kind = "array<struct<kind:string,start:int,end:int>>"
    return map_texts(plain, f"base {kind}, added {kind}", mark)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span, or union of overlapping spans, replaced by its kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, others) with all spans of ``text`` replaced; a null text stays null."""
    weights = fit_field(docs.withColumn("text", F.coalesce("text", F.lit(""))))

    def mask(texts: list[str | None]) -> list[list]:
        out = []
        for t in texts:
            base, added = find_spans(t or "", weights)
            out.append(masked(t, base + added) if base or added else t)
        return [out]

    return map_texts(docs, "text string", mask)


def digest_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of each row."""
    found = mark_personal_data(texts_of(docs))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    every = F.transform(
        F.array_sort(F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s.alias("span")),
        )),
        lambda x: x["span"],
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(every).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
