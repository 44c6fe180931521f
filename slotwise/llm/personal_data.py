"""Personal data: fixed patterns, and spans that a semi-Markov conditional random field adds.

Around digits, ``@`` and spelled-out addresses a text is cut into atoms (letters, digits, single signs). A segment of up to
``LONGEST`` atoms has features of its whole string: number and grouping of its digits, checksum, octets, separators, ends,
words before it. The field scores segmentations into such segments and plain atoms; dynamic programming over
ends and lengths finds the best boundaries and types together. It is trained here, by likelihood, on a bounded
sample of texts with their pattern matches, and on rewritten and unrelated forms placed into those texts.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
#: Bounds of training: sampled texts, windows, passes.
SAMPLE, WINDOWS, PASSES = 300, 500, 60
LONGEST = 12
CONTEXT = 4

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_TRIGGER = re.compile(r"[0-9@]|(?i:[(\[] ?at ?[)\]])|(?i:\bat\b(?=\W+\w+\W+dot\b))")
_NEAR = {
    "email": {"mail", "email", "e", "contact", "write"}, "ip": {"ip", "host", "server", "address", "addr"},
    "card": {"card", "visa", "credit", "mastercard", "payment"}, "phone": {"phone", "tel", "call", "mobile", "fax", "telephone"},
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping for each kind, failing matches dropped."""
    out = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > last and _LOCAL.match(text, start - 1):
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                last = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 12 <= m.end() - m.start():
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- atoms, windows, features -----------------------------------------------------------


def windows(text: str, taken: list[tuple[int, int, int]]):
    """Lists of atoms (start, end) around triggers that lie outside the spans ``taken``."""
    triggers = [m.start() for m in _TRIGGER.finditer(text)]
    if not triggers:
        return
    spans = iter(sorted((s, e) for s, _, e in taken))
    held, free = next(spans, None), []
    reach = 0
    for t in triggers:
        while held and held[0] <= t:
            reach, held = max(reach, held[1]), next(spans, None)
        if t >= reach:
            free.append(t)
    at, ranges = 0, []
    while at < len(free):
        lo = max(0, free[at] - 80)
        hi = free[at] + 80
        at += 1
        while at < len(free) and free[at] <= hi:
            hi = free[at] + 80
            at += 1
        # Whole words at the left end; what reaches into the window before is one with it.
        limit = ranges[-1][1] if ranges else 0
        while lo > limit and not text[lo - 1].isspace():
            lo -= 1
        if ranges and lo <= limit:
            ranges[-1][1] = hi
        else:
            ranges.append([lo, hi])
    for lo, hi in ranges:
        yield [(m.start(), m.end()) for m in _ATOM.finditer(text, lo, min(hi, len(text)))]


NAMES = (
    "one", "digits 0", "digits 1-6", "digits 7-8", "digits 9-11", "digits 12-19", "digits more", "luhn", "octets", "at sign", "at word", "dot word",
    "dots 0", "dots 1-2", "dots 3", "dots more", "plus first", "open first", "digit first", "digit last", "letter first", "letter last", "short end", "fours",
    "three three four", "letters", "digits and blanks", "phone signs", "touches left", "touches right", "dot left", "dot right", "number left", "number right",
    "near email", "near ip", "near card", "near phone", "atoms 1", "atoms 2-6", "atoms more", "closed brackets", "long group", "other signs",
)
_PLAIN = re.compile(r"[0-9 .-]+")
_PHONE_SIGNS = re.compile(r"\+?[0-9 ().-]+")
_AT_WORD = re.compile(r"(?i)[(\[] ?at ?[)\]]|\bat\b(?=.*\bdot\b)")
_DOT_WORD = re.compile(r"(?i)[(\[] ?dot ?[)\]]|\bdot\b")
_OTHER = re.compile(r"[^A-Za-z0-9 ().+\[\]@_%-]")


def features(text: str, atoms: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """Numbers of the features that hold for the segment of atoms i..j - 1."""
    start, end = atoms[i][0], atoms[j - 1][1]
    s = text[start:end]
    groups = re.findall("[0-9]+", s)
    digits = "".join(groups)
    n, dots, sizes = len(digits), s.count("."), [len(g) for g in groups]
    before = {text[a:b].lower() for a, b in atoms[max(0, i - 3): i]}
    left, right = text[start - 1: start], text[end: end + 1]
    on = [
        True, n == 0, 1 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 19, n > 19, 12 <= n <= 19 and luhn(digits),
        len(groups) == 4 and all(k <= 3 for k in sizes) and all(int(g) <= 255 for g in groups), s.count("@") == 1, bool(_AT_WORD.search(s)), bool(_DOT_WORD.search(s)),
        dots == 0, 1 <= dots <= 2, dots == 3, dots > 3, s[0] == "+", s[0] in "([", s[0].isdigit(), s[-1].isdigit(), s[0].isalpha(), s[-1].isalpha(),
        bool(re.search(r"(?i)(?:\.|dot[)\]]?) ?[a-z]{2,4}$", s)), sizes in ([4] * 3, [4] * 4), sizes in ([3, 3, 4], [1, 3, 3, 4], [2, 3, 3, 4]),
        bool(re.search("[A-Za-z]", s)), bool(_PLAIN.fullmatch(s)), bool(_PHONE_SIGNS.fullmatch(s)), left.isalnum(), right.isalnum(),
        left in tuple(".@-+_/:") and left != "", right in tuple("@-_/:") and right != "", i > 0 and text[atoms[i - 1][0]].isdigit(), j < len(atoms) and text[atoms[j][0]].isdigit(),
        *[bool(before & _NEAR[k]) for k in KINDS], j - i == 1, 2 <= j - i <= 6, j - i > 6,
        s.count("(") == s.count(")") and s.count("[") == s.count("]"), any(k > 4 for k in sizes), bool(_OTHER.search(s)),
    ]
    return [k for k, x in enumerate(on) if x]


_ON = {name: i for i, name in enumerate(NAMES)}


def possible(on: list[int]) -> np.ndarray:
    """Kinds a segment can be at all: an address has its sign, an ip its octets, a card its checksum, a phone 7 to 15 digits or so."""
    has = {n: _ON[n] in on for n in ("at sign", "at word", "dot word", "dots 0", "octets", "luhn", "digits 7-8", "digits 9-11", "digits 12-19", "letters")}
    address = has["at sign"] or (has["at word"] and (has["dot word"] or not has["dots 0"]))
    phone = not has["letters"] and (has["digits 7-8"] or has["digits 9-11"] or has["digits 12-19"])
    return np.array([address, has["octets"] and not has["letters"], has["luhn"] and not has["letters"], phone])


def segments(text: str, atoms: list[tuple[int, int]]):
    """(i, j) of the segments worth scoring: with a trigger inside, no line break, no gap beyond a blank, and sensible ends."""
    n = len(atoms)
    strings = [text[a:b] for a, b in atoms]
    hot = [bool(_TRIGGER.match(text, a)) for a, _ in atoms]
    first = [s[0].isalnum() or s in "+([" for s in strings]
    for i in range(n):
        if not first[i]:
            continue
        seen = False
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            if j - 1 > i and (atoms[j - 1][0] - atoms[j - 2][1] > 1 or text[atoms[j - 2][1]: atoms[j - 1][0]] not in ("", " ")):
                break
            seen |= hot[j - 1]
            if seen and (strings[j - 1][0].isalnum() or (strings[j - 1] in ")]" and j - i > 1)):
                yield i, j


# --- the field -----------------------------------------------------------------------


def best_segments(n: int, scored: list[tuple[int, int, np.ndarray]], moves: np.ndarray) -> list[tuple[int, int, int]]:
    """Best segmentation of n atoms: (i, j, kind). ``scored``: segments and their scores by kind; ``moves``: scores of one label
    after another, label 0 being a plain atom."""
    ending: dict[int, list] = {}
    for i, j, score in scored:
        ending.setdefault(j, []).append((i, score))
    value = np.full((n + 1, 5), -np.inf)
    value[0, 0] = 0.0
    back: list[list] = [[None] * 5 for _ in range(n + 1)]
    for j in range(1, n + 1):
        plain = value[j - 1] + moves[:, 0]
        k = int(plain.argmax())
        value[j, 0], back[j][0] = plain[k], (j - 1, k)
        for i, score in ending.get(j, ()):
            entry = value[i][:, None] + moves[:, 1:]
            origin = entry.argmax(axis=0)
            total = entry[origin, range(4)] + score
            for y in np.flatnonzero(total > value[j, 1:]).tolist():
                value[j, y + 1], back[j][y + 1] = total[y], (i, int(origin[y]))
    out, j, y = [], n, int(value[n].argmax())
    while j:
        i, before = back[j][y]
        if y:
            out.append((i, j, y - 1))
        j, y = i, before
    return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = np.maximum(x.max(axis=axis, keepdims=True), -1e30)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis) + 1e-300)


def fit(examples: list[tuple[int, list, list]], passes: int = PASSES, rate: float = 0.15, decay: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x kinds) and moves (5 x 5) of greatest penalised likelihood, by gradient steps over all windows.

    An example is (atoms, segments as (i, j, features), gold as (i, j, kind)).
    """
    count, longest = len(examples), max(n for n, _, _ in examples)
    ends = np.array([n for n, _, _ in examples])
    where, held, open_kinds = [], [], []
    gold_weights, gold_moves = np.zeros((len(NAMES), 4)), np.zeros((5, 5))
    for b, (n, found, gold) in enumerate(examples):
        by_place = {}
        for i, j, on in found:
            where.append((b, j, j - i))
            held.append(np.isin(np.arange(len(NAMES)), on))
            open_kinds.append(possible(on))
            by_place[i, j] = on
        label, at = 0, 0
        for i, j, kind in [*gold, (n, n, None)]:
            for _ in range(at, i):
                gold_moves[label, 0] += 1
                label = 0
            if kind is not None:
                gold_moves[label, kind + 1] += 1
                gold_weights[by_place[i, j], kind] += 1
                label = kind + 1
            at = j
    place = tuple(np.array(where).reshape(-1, 3).T)
    phi, closed = np.array(held, np.float64).reshape(-1, len(NAMES)), ~np.array(open_kinds, bool).reshape(-1, 4)
    weights, moves = np.zeros((len(NAMES), 4)), np.zeros((5, 5))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    rows = np.arange(count)
    for step in range(1, passes + 1):
        score = np.full((count, longest + 1, LONGEST + 1, 4), -np.inf)
        score[place] = np.where(closed, -np.inf, phi @ weights)
        forward = np.full((count, longest + 1, 5), -np.inf)
        forward[:, 0, 0] = 0
        entry = np.full((count, longest + 1, 5), -np.inf)
        for t in range(longest + 1):
            if t:
                forward[:, t, 0] = entry[:, t - 1, 0]
                reach = min(LONGEST, t)
                parts = np.stack([entry[:, t - k, 1:] + score[:, t, k] for k in range(1, reach + 1)], axis=1)
                forward[:, t, 1:] = _log_sum(parts, 1)
            entry[:, t] = _log_sum(forward[:, t, :, None] + moves[None], 1)
        total = _log_sum(forward[rows, ends], 1)
        rest = np.full((count, longest + 2, 5), -np.inf)
        onward = np.full((count, longest + 1, 5), -np.inf)
        for t in range(longest, -1, -1):
            if t < longest:
                onward[:, t, 0] = rest[:, t + 1, 0]
                reach = min(LONGEST, longest - t)
                parts = np.stack([score[:, t + k, k] + rest[:, t + k, 1:] for k in range(1, reach + 1)], axis=1)
                onward[:, t, 1:] = _log_sum(parts, 1)
            rest[:, t] = _log_sum(moves[None] + onward[:, t, None, :], 2)
            rest[ends == t, t] = 0
        share = np.zeros_like(score)
        for k in range(1, LONGEST + 1):
            share[:, k:, k] = np.exp(np.minimum(entry[:, : longest + 1 - k, 1:] + score[:, k:, k] + rest[:, k: longest + 1, 1:] - total[:, None, None], 0))
        flow = np.exp(np.minimum(forward[:, :, :, None] + moves[None, None] + onward[:, :, None, :] - total[:, None, None, None], 0))
        flow[np.arange(longest + 1)[None, :] >= ends[:, None]] = 0
        grads = (
            (gold_weights - phi.T @ share[place]) / count - decay * weights,
            (gold_moves - flow.sum(axis=(0, 1))) / count - decay * moves,
        )
        for n, (target, grad) in enumerate(((weights, grads[0]), (moves, grads[1]))):
            m, v = state[2 * n], state[2 * n + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            target += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights, moves


# --- training texts --------------------------------------------------------------------


def _digits(r: random.Random, n: int) -> str:
    return str(r.randrange(1, 10)) + "".join(str(r.randrange(10)) for _ in range(n - 1))


def _card(r: random.Random) -> str:
    head = _digits(r, 15)
    return head + next(c for c in "0123456789" if luhn(head + c))


def _forms(r: random.Random, words: list[str]) -> tuple[int | None, str]:
    """A span of a kind in a plain or rewritten form, or (None) numbers and words that are none."""
    name = lambda: re.sub("[^a-z]", "", r.choice(words).lower()) or "name"
    kind = r.choice((0, 1, 2, 3, None))
    if kind == 0:
        user, host, end = name() + r.choice(("", "." + name(), _digits(r, 2))), name(), r.choice(("com", "org", "net", "de"))
        return 0, r.choice((f"{user}@{host}.{end}", f"{user} (at) {host}.{end}", f"{user}[at]{host}.{end}", f"{user} [at] {host} [dot] {end}", f"{user} at {host} dot {end}", f"{user} @ {host}.{end}"))
    if kind == 1:
        parts = [str(r.randrange(1, 256)) for _ in range(4)]
        return 1, r.choice((".".join(parts), " . ".join(parts), "[.]".join(parts)))
    if kind == 2:
        card = _card(r)
        fours = [card[i: i + 4] for i in range(0, 16, 4)]
        return 2, r.choice((card, " ".join(fours), "-".join(fours), ".".join(fours)))
    if kind == 3:
        a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
        return 3, r.choice((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{_digits(r, 2)} {a} {b} {c}"))
    year, month, day = r.randrange(1900, 2100), r.randrange(1, 13), r.randrange(1, 29)
    return None, r.choice((
        f"{year}-{month:02}-{day:02}", f"{day}.{month}.{year}", str(year), _digits(r, r.randrange(1, 7)), f"{r.randrange(1, 999)}.{r.randrange(0, 99):02}", f"{r.randrange(10)}.{r.randrange(20)}.{r.randrange(20)}",
        f"{r.randrange(24)}:{r.randrange(60):02}", f"{name()} at {name()}", f"{_digits(r, 2)} {_digits(r, 3)} {_digits(r, 2)}", f"{name()}{_digits(r, 3)}", f"{_digits(r, 5)}-{_digits(r, 4)}", f"@{name()}", _digits(r, 12)[:-1] + "x"))


def training_windows(texts: list[str], count: int = WINDOWS, seed: int = 7) -> list[tuple[int, list, list]]:
    """Windows of the sampled texts with their pattern matches, then forms set between words of those texts."""
    r = random.Random(seed)
    pairs = [(t, base_spans(t)) for t in texts]
    words = [w for t in texts for w in t.split()[:40] if w.isalpha()] or ["word", "text", "line", "page"]
    cases = []
    for text, gold in pairs:
        for s, k, e in gold[:1]:
            lo, hi = max(0, s - 40), min(len(text), e + 40)
            part = text[lo:hi]
            cases.append((part, base_spans(part)))
    cases = cases[: count // 3]
    while len(cases) < count:
        kind, form = _forms(r, words)
        lead = " ".join(r.choice(words) for _ in range(r.randrange(0, 4)))
        if kind is not None and r.random() < 0.3:
            lead += " " + r.choice(sorted(_NEAR[KINDS[kind]]))
        part = f"{lead} {form}{r.choice(('', '.', ',', ''))} " + " ".join(r.choice(words) for _ in range(r.randrange(0, 4)))
        cases.append((part, [] if kind is None else [(len(lead) + 1, kind, len(lead) + 1 + len(form))]))
    out = []
    for text, gold in cases:
        atoms = [(m.start(), m.end()) for m in _ATOM.finditer(text)][:40]
        if not atoms:
            continue
        found = [(i, j, features(text, atoms, i, j)) for i, j in segments(text, atoms)]
        places = {(atoms[i][0], atoms[j - 1][1]): (i, j) for i, j, _ in found}
        wanted = sorted((*places[s, e], k) for s, k, e in gold if (s, e) in places)
        flat = [g for n, g in enumerate(wanted) if not n or g[0] >= wanted[n - 1][1]]
        kinds = {(i, j): possible(on) for i, j, on in found}
        if len(wanted) == len(gold) == len(flat) and all(kinds[i, j][k] for i, j, k in flat):
            out.append((len(atoms), found, flat))
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Fit the field on at most ``sample`` texts: those of the smallest hash among texts with a digit or ``@``, 4,000 characters of each."""
    rows = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    # Hashes first, so that tasks don't each send a sample of texts.
    chosen = [r.h for r in rows.select("h").orderBy("h").limit(sample).collect()]
    found = rows.where(F.col("h").isin(chosen)).select("h", F.substring("text", 1, 4000).alias("text")).dropDuplicates(["h"])
    texts = [r.text for r in sorted(found.collect(), key=lambda r: r.h)]
    return fit(training_windows(texts))


def score_segments(text: str, atoms: list[tuple[int, int]], weights: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Segments that can be of some kind, and their scores by kind."""
    out = []
    for i, j in segments(text, atoms):
        on = features(text, atoms, i, j)
        kinds = possible(on)
        if kinds.any():
            out.append((i, j, np.where(kinds, weights[on].sum(axis=0), -np.inf)))
    return out


def added_spans(text: str, base: list[tuple[int, int, int]], weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the field that meet no base span."""
    out = []
    for atoms in windows(text, base):
        scored = score_segments(text, atoms, weights)
        if not scored:
            continue
        for i, j, kind in best_segments(len(atoms), scored, moves):
            s, e = atoms[i][0], atoms[j - 1][1]
            if all(e <= a or b <= s for a, _, b in base):
                out.append((s, kind, e))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and hash are those of the fixed patterns; ``spans`` holds these and what the field adds. Offsets are code points, ends
    exclusive. Null and empty texts have no spans; a text of any length is decoded as a whole; rows are answered one by one, so repeated rows and ids are kept; other columns
    are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    weights, moves = train(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for text in part.column("text").to_pylist():
                    base = base_spans(text)
                    more = added_spans(text, base, weights, moves)
                    counts = [sum(k == n for _, k, _ in base) for n in range(4)]
                    out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more), len(more)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return rows.mapInArrow(run, schema)
