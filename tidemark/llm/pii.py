"""Personal data: fixed patterns, and a linear-chain CRF that adds to them (operator 10).

The CRF labels tokens (runs of characters other than white space) that hold a digit or
an at sign, with B- and I- labels of four kinds; any other token is outside by
definition and ends a chain. It learns from a small labelled table of lines and decodes
the chains of a block of texts together, by Viterbi in numpy.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, text_blocks

KINDS = ("email", "ip", "card", "phone")

# Lines with marked spans, {kind text}: what the CRF learns from unless given others.
LABELLED_LINES = (
    "call {phone (743) 555-3824} after lunch",
    "my number is {phone 743-555-3824} thanks",
    "tel {phone 743 555 3824} or write",
    "phone {phone 555-3824} for details",
    "reach us at {phone +1 (521) 555-6210} any day",
    "fax {phone 0049 30 1234567} in the office",
    "mobile {phone +44 20 7946 0958} please",
    "the desk {phone 1-800-555-0199} is open",
    "dial {phone (310) 555-4510} and ask",
    "phone {phone 743.555.3824} at noon",
    "ring {phone 030 901820} before ten",
    "pay with {card 4785380592391139} today",
    "card {card 4785 3805 9239 1139} expires soon",
    "visa {card 4785-3805-9239-1139} was charged",
    "the card {card 371449635398431} is lost",
    "charge {card 6011 0009 9013 9424} now",
    "number {card 5555555555554444} on file",
    "card {card 4785380592391138} was refused",
    "amex {card 3714 496353 98431} belongs here",
    "host {ip 152.143.123.131} answered",
    "from {ip 10.0.0.1} to {ip 192.168.4.20} over",
    "the server {ip 8.196.197.208} is down",
    "ping {ip 127.0.0.1:8080} failed",
    "address {ip 172.16.254.1/24} is taken",
    "login from {ip 233.233.171.252} was seen",
    "write to {email that.92@mail2.example.com} soon",
    "mail {email jane@localhost} about it",
    "contact {email a.b+c@sub.example.org} first",
    "my address is {email jane.doe@example.co.uk} now",
    "send it to {email team@example} please",
    "from {email 19@mail5.example.com} and {email re.46@mail8.example.com} both",
    "in 1998 and 2024 it rained",
    "the price was 12,345.67 in 2023",
    "version 1.2.3 of 2024-01-05 at 12:30",
    "page 17 of 240 in volume 3",
    "about 3.5 million people in 40 towns",
    "build 20240105 passed 1200 tests",
    "commit 4439e3e49cf46b2d7c90f3602a3d0b907ff is fine",
    "token 2321bac4d15ec8f90433955bf9d3cf61da5bdd1e was revoked",
    "the score was 3-2 after 90 minutes",
    "chapter 2 and sections 4.1 and 4.2.1",
    "on 05/01/2024 or 05.01.2024 we met",
    "order 100200300 has 25 items",
    "it weighs 70 kg and costs 1 000 000 francs",
    "follow @handle or @team2 online",
    "room 101 floor 4 at 18:45:10",
    "from 1,000 to 10,000 of 100,000",
    "the id 7 8 9 10 11 12 list",
    "isbn 978-3-16-148410-0 was printed",
    "temperatures of -12.5 and 101.3 at 2am",
)

SPECIAL = np.zeros(256, dtype=bool)
SPECIAL[list(b"0123456789@")] = True
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_EDGES = "\"'`.,;:!?*#%&$|<>[]{}=~_/\\"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, kind, end in code points


class Model(NamedTuple):
    """Weights by feature, transitions between labels, and into and out of a chain."""

    features: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray
    first: np.ndarray
    last: np.ndarray


N_LABELS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2k begins kind k, 2 + 2k goes on with it


def luhn(digits: str) -> bool:
    numbers = [int(d) for d in reversed(digits)]
    doubled = (2 * d - 9 * (d > 4) for d in numbers[1::2])
    return (sum(numbers[::2]) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and non-overlapping for each kind.

    E-mail addresses are looked up from their at signs and addresses of four numbers
    from chains of dotted numbers: the same matches, in time linear in the text.
    """
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, 0, done))
        at = text.find("@", at + 1)
    for chain in _DOTTED.finditer(text):
        parts = list(_DIGITS.finditer(text, *chain.span()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(_at_most_255(part.group()) for part in four):
                found.append((four[0].start(), 1, four[3].end()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() < 12:
            continue
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in match.group()) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def _at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def shape(token: str) -> str:
    """The token with letters as ``a`` in runs of one and digits as ``0`` in runs of
    up to five: ``(743)`` is ``(000)``, ``jane.d@x`` is ``a.a@a``."""
    out: list[str] = []
    run = 0
    for c in token[:64]:
        kind = "0" if "0" <= c <= "9" else "a" if c.isalpha() else c
        run = run + 1 if out and out[-1] == kind else 1
        if run <= (5 if kind == "0" else 1):
            out.append(kind)
    return "".join(out)


def token_features(tokens: list[str], i: int) -> tuple[str, ...]:
    """Features of a token by its shape, its digits and its neighbours."""
    own = tokens[i].strip(_EDGES)
    digits = sum("0" <= c <= "9" for c in own)
    before = tokens[i - 1].strip(_EDGES) if i else "<start>"
    after = tokens[i + 1].strip(_EDGES) if i + 1 < len(tokens) else "<end>"
    return (
        "bias",
        "s=" + shape(own),
        f"d={min(digits, 16)}",
        f"@{'@' in own}",
        f"dots={min(own.count('.'), 4)}",
        f"start={own[:1] if not own[:1].isalnum() else ''}",
        f"letters={any(c.isalpha() for c in own)}",
        "p=" + (shape(before) if is_special(before) else before.lower()),
        "n=" + (shape(after) if is_special(after) else "word"),
    )


def is_special(token: str) -> bool:
    return any("0" <= c <= "9" or c == "@" for c in token)


def read_line(line: str) -> tuple[list[str], list[int]]:
    """Tokens and labels of a line with marked spans."""
    tokens: list[str] = []
    labels: list[int] = []
    for part in re.split(r"(\{[^}]*\})", line):
        if part.startswith("{"):
            kind, *own = part[1:-1].split()
            k = KINDS.index(kind)
            labels += [1 + 2 * k] + [2 + 2 * k] * (len(own) - 1)
        else:
            own = part.split()
            labels += [0] * len(own)
        tokens += own
    return tokens, labels


@lru_cache(maxsize=8)
def train(lines: tuple[str, ...] = LABELLED_LINES, steps: int = 300, penalty: float = 0.01) -> Model:
    """Fit the CRF to marked lines by gradient steps on the penalised likelihood.

    The table is small and part of the program, or given by the caller: it does not grow
    with the documents.
    """
    chains: list[list[tuple[tuple[str, ...], int]]] = []
    for line in lines:
        tokens, labels = read_line(line)
        open_ = False
        for i, token in enumerate(tokens):
            if not is_special(token):
                open_ = False
                continue
            if not open_:
                chains.append([])
            chains[-1].append((token_features(tokens, i), labels[i]))
            open_ = True
    features = {name: n for n, name in enumerate(dict.fromkeys(f for c in chains for x, _ in c for f in x))}
    longest = max(map(len, chains))
    sizes = np.array([len(c) for c in chains])
    held = np.zeros((len(chains), longest, len(features)))
    gold = np.zeros((len(chains), longest), dtype=int)
    for c, chain in enumerate(chains):
        for t, (names, label) in enumerate(chain):
            held[c, t, [features[f] for f in names]] = 1
            gold[c, t] = label
    inside = np.arange(longest) < sizes[:, None]
    rows = np.arange(len(chains))
    one = np.eye(N_LABELS)

    weights = [
        np.zeros((len(features), N_LABELS)),
        np.zeros((N_LABELS, N_LABELS)),
        np.zeros(N_LABELS),
        np.zeros(N_LABELS),
    ]
    seen = one[gold] * inside[..., None]
    pairs = np.einsum("cti,ctj->ij", seen[:, :-1], seen[:, 1:])
    observed = [
        np.einsum("ctf,ctl->fl", held, seen),
        pairs,
        seen[:, 0].sum(0),
        one[gold[rows, sizes - 1]].sum(0),
    ]
    moment = [np.zeros_like(w) for w in weights]
    spread = [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        emission, (transition, first, last) = held @ weights[0], weights[1:]
        forward = np.zeros((len(chains), longest, N_LABELS))
        forward[:, 0] = emission[:, 0] + first
        for t in range(1, longest):
            forward[:, t] = emission[:, t] + _log_sum(forward[:, t - 1, :, None] + transition, 1)
        backward = np.zeros_like(forward)
        for t in range(longest - 1, -1, -1):
            ahead = np.zeros((len(chains), N_LABELS))
            if t + 1 < longest:
                ahead = _log_sum(transition + (emission + backward)[:, t + 1, None, :], 2)
            ends = (sizes == t + 1)[:, None]
            backward[:, t] = np.where(ends, last, ahead)
        total = _log_sum(forward[rows, sizes - 1] + last, 1)
        single = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
        joint = np.exp(
            forward[:, :-1, :, None]
            + transition
            + (emission + backward)[:, 1:, None, :]
            - total[:, None, None, None]
        )
        joint *= inside[:, 1:, None, None]
        expected = [
            np.einsum("ctf,ctl->fl", held, single),
            joint.sum((0, 1)),
            single[:, 0].sum(0),
            single[rows, sizes - 1].sum(0),
        ]
        for k, w in enumerate(weights):
            gradient = observed[k] - expected[k] - penalty * w
            moment[k] = 0.9 * moment[k] + 0.1 * gradient
            spread[k] = 0.99 * spread[k] + 0.01 * gradient**2
            scale = np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-8
            weights[k] = w + 0.1 * (moment[k] / (1 - 0.9**step)) / scale
    # A span goes on only with a label of its own kind.
    transition = weights[1].copy()
    for k in range(len(KINDS)):
        for before in range(N_LABELS):
            if before not in (1 + 2 * k, 2 + 2 * k):
                transition[before, 2 + 2 * k] = -1e9
    first = weights[2].copy()
    first[2::2] = -1e9
    return Model(features, weights[0], transition, first, weights[3])


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis)


def viterbi(emission: np.ndarray, starts: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    """The best labels of many chains at once; chain c is the rows from starts[c]."""
    labels = np.zeros(len(emission), dtype=np.int64)
    if not len(emission):
        return labels
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    came = np.zeros(emission.shape, dtype=np.int8)
    score = emission[starts] + model.first
    ends = np.zeros(len(starts), dtype=np.int64)
    for t in range(1, int(sizes[0]) + 1):
        active = int(np.searchsorted(-sizes, -t, side="left"))  # chains longer than t
        stop = slice(active, len(score))
        ends[stop] = (score[stop] + model.last).argmax(1)
        score = score[:active]
        if not active:
            break
        paths = score[:, :, None] + model.transition
        came[starts[:active] + t] = paths.argmax(1)
        score = paths.max(1) + emission[starts[:active] + t]
    now = ends
    for t in range(int(sizes[0]) - 1, -1, -1):
        active = int(np.searchsorted(-sizes, -t, side="left"))
        labels[starts[:active] + t] = now[:active]
        now = now.copy()
        now[:active] = came[starts[:active] + t, now[:active]]
    return labels


def _plausible(kind: int, text: str) -> bool:
    digits = sum("0" <= c <= "9" for c in text)
    if kind == 0:
        return "@" in text.strip("@")
    if kind == 1:
        return len(_DIGITS.findall(text)) >= 4
    if kind == 2:
        return 12 <= digits <= 19
    return 7 <= digits <= 15


class _Emissions:
    """Label scores of a token by its features, kept for features met before."""

    def __init__(self, model: Model, limit: int = 100_000):
        self.model, self.limit = model, limit
        self.known: dict[tuple[str, ...], np.ndarray] = {}

    def __call__(self, names: tuple[str, ...]) -> np.ndarray:
        scores = self.known.get(names)
        if scores is None:
            places = [self.model.features[n] for n in names if n in self.model.features]
            scores = self.model.emission[places].sum(0)
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[names] = scores
        return scores


def crf_spans(texts: list[bytes], score: _Emissions) -> list[list[Span]]:
    """Spans the CRF finds in each text, in code points."""
    found: list[list[Span]] = [[] for _ in texts]
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    places = np.flatnonzero(SPECIAL[data])
    if not len(places):
        return found
    gaps = np.flatnonzero(SPACE[data])  # every text ends in one
    after = np.unique(np.searchsorted(gaps, places))  # tokens with a special character
    begins = np.where(after > 0, gaps[after - 1] + 1, 0)
    ends = gaps[after]
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    owner = np.searchsorted(text_ends, begins, side="right")
    text_starts = np.concatenate([[0], text_ends[:-1] + 1])
    points = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)  # code points up to and with a byte
    raw = data.tobytes()
    # A chain goes on where only white space lies between two special tokens of a text.
    blank = np.cumsum(~SPACE[data], dtype=np.int32)
    joined = (owner[1:] == owner[:-1]) & (blank[begins[1:] - 1] == blank[ends[:-1] - 1])
    new = np.concatenate([[True], ~joined])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(begins)))

    tokens = [raw[b:e].decode() for b, e in zip(begins.tolist(), ends.tolist())]
    names = []
    for c, size in zip(starts.tolist(), sizes.tolist()):
        low, high = text_starts[owner[c]], text_ends[owner[c]]
        left = raw[max(low, begins[c] - 80) : begins[c]].split()[-1:]
        right = raw[ends[c + size - 1] : min(high, ends[c + size - 1] + 80)].split()[:1]
        left = [w.decode(errors="ignore") for w in left]
        right = [w.decode(errors="ignore") for w in right]
        line = left + tokens[c : c + size] + right
        names += [token_features(line, len(left) + i) for i in range(size)]
    labels = viterbi(np.array([score(n) for n in names]), starts, sizes, score.model)

    i = 0
    while i < len(labels):
        label = int(labels[i])
        if label == 0:
            i += 1
            continue
        j = i + 1
        while j < len(labels) and not new[j] and labels[j] == label + 1:
            j += 1
        lead = len(tokens[i]) - len(tokens[i].lstrip(_EDGES))
        trail = len(tokens[j - 1]) - len(tokens[j - 1].rstrip(_EDGES))
        text = int(owner[i])
        base = int(points[text_starts[text] - 1]) if text_starts[text] else 0
        first = int(points[begins[i]]) - 1 - base + lead
        last = int(points[ends[j - 1] - 1]) - base - trail
        kind = (label - 1) // 2
        if first < last and _plausible(kind, raw[begins[i] : ends[j - 1]].decode()):
            found[text].append((first, kind, last))
        i = j
    return found


def find_spans(texts: list[bytes], score: _Emissions) -> list[tuple[list[Span], list[Span]]]:
    """For each text the base spans, and all: base ones and those the CRF adds where no
    base span is."""
    out = []
    for text, added in zip(texts, crf_spans(texts, score)):
        base = base_spans(text.decode())
        free = [s for s in added if not any(s[0] < b[2] and b[0] < s[2] for b in base)]
        out.append((base, sorted(base + free)))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def personal_data(
    documents: DataFrame,
    lines: tuple[str, ...] = LABELLED_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Personal data in every row of ``documents``.

    Returns ``(id, n_email, n_ip, n_card, n_phone, base_sha256, n_added, spans)``. The
    four counts and the digest are of the base spans; ``spans`` lists all as
    kind:start:end in code points, end exclusive, by start and then kind, comma-joined.
    Spans of the CRF that touch a base span are left out, as are those without the
    digits or the at sign that their kind needs.

    A null text counts as empty: no spans. Ids may be null or repeat. Other columns are
    ignored. Whole texts are searched, whatever their length.
    """
    model = train(tuple(lines))
    memo: list[_Emissions] = []

    def work(texts: list[bytes | None]) -> dict[str, list]:
        if not memo:
            memo.append(_Emissions(model))
        found = find_spans([text or b"" for text in texts], memo[0])
        made: dict[str, list] = {
            f"n_{kind}": [sum(s[1] == k for s in base) for base, _ in found]
            for k, kind in enumerate(KINDS)
        }
        made["base_sha256"] = [hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in found]
        made["n_added"] = [len(every) - len(base) for base, every in found]
        made["spans"] = [_joined(every) for _, every in found]
        return made

    fields = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    fields += ", base_sha256 string, n_added bigint, spans string"
    return map_texts(documents, id_col, text_col, fields, work)


def redact(
    documents: DataFrame,
    lines: tuple[str, ...] = LABELLED_LINES,
    text_col: str = "text",
) -> DataFrame:
    """``documents`` with every span of personal data replaced by its kind, ``<phone>``.

    All columns and rows stay; null texts stay null.
    """
    model = train(tuple(lines))
    memo: list[_Emissions] = []

    def replaced(text: bytes, spans: list[Span]) -> str:
        points, parts, done = text.decode(), [], 0
        for start, kind, end in spans:
            if start >= done:
                parts += [points[done:start], f"<{KINDS[kind]}>"]
            done = max(done, end)
        return "".join([*parts, points[done:]])

    def run(batches):
        if not memo:
            memo.append(_Emissions(model))
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part, own in text_blocks(batch, at):
                found = find_spans([t or b"" for t in own], memo[0])
                new = [None if t is None else replaced(t, every) for t, (_, every) in zip(own, found)]
                yield part.set_column(at, text_col, pa.array(new, pa.string()))

    return documents.mapInArrow(run, documents.schema)
