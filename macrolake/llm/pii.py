"""Personal data by patterns and a semi-Markov conditional random field.

Four base kinds are found by fixed patterns. The field adds what patterns miss:
secrets, and spelled-out addresses and numbers. It reads stretches of a text
around words with digits, ``@`` or ``=``, words that tell of secrets, cloud key
prefixes and spelled-out "at" and "dot"; every run of up to
``LONGEST`` words there is a candidate segment, scored for each kind by features
of the whole span (character classes and their counts, length, separators,
telling words, hexadecimal runs, the word before). Dynamic programming over
segment ends, with lengths bounded, chooses boundaries and kinds together.
Stretches of any length are decoded in linear time.

The weights are trained here by the likelihood of the field (forward-backward
over segments) on sentences made by rule, so no text of the corpus is a label.

Rows: a null or empty text holds nothing. Repeated rows are searched each.
Other columns are not read. An empty table gives no rows. Offsets are in
code points, ends exclusive.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import per_batch, text_of

#: Words of a segment at most, and words on each side of a telling word that belong to its stretch.
LONGEST = 6
AROUND = LONGEST - 1
#: Fixed: the order of kinds in results. The field knows the same kinds and secrets.
KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("other", *KINDS)

# Fixed: the base patterns. Addresses are matched around each "@", see emails().
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_RUN = re.compile(r"[0-9][\x20().0-9-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Each match has its ``@`` right behind the longest run of local characters, so looking around each ``@`` finds all."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else free
        if found:
            out.append(("email", start, found.end()))
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """The spans of the four base kinds, by kind, then start."""
    ips, cards, phones = [], [], []
    for run in _RUN.finditer(text):  # every number lies in one such run, with "+" before it or not
        at, piece = run.start(), run[0]
        if at and text[at - 1] == "+":
            at, piece = at - 1, "+" + piece
        if len(piece) < 7:
            continue
        ips += [("ip", at + m.start(), at + m.end()) for m in _IP.finditer(piece) if is_ip(m[0])]
        cards += [("card", at + m.start(), at + m.end()) for m in _CARD.finditer(piece) if is_card(m[0])]
        phones += [("phone", at + m.start(), at + m.end()) for m in _PHONE.finditer(piece) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return emails(text) + ips + cards + phones


#: Fixed: words that tell of secrets and spelled-out addresses.
_KEYS = "password|passwd|pwd|token|secret|apikey|api_key|access_key|private_key"
# An "at" without brackets tells of an address before a name with a dot; other addresses have a spelled-out dot.
_TELLING = re.compile(
    rf"[0-9@=]|{_KEYS}|(?:AKIA|ASIA)[A-Z]{{16}}|[\[(](?:at|dot)[\])]|(?<!\w)dot(?!\w)|(?<!\w)at\s+[\w-]+\.\w", re.IGNORECASE
)
_KEY = re.compile(rf"(?:{_KEYS})", re.IGNORECASE)
_HEX = re.compile(r"[0-9a-f]{12,}|[0-9A-F]{12,}")
_CLOUD = re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b")
_TRIM = "\"'“”„»«().,;:!?#*$%&|<>"


@lru_cache(maxsize=50_000)
def span_features(before: str, span: str, n_words: int) -> tuple[str, ...]:
    """Features of a whole candidate span."""
    core = span.strip(_TRIM)
    digits, letters = sum(c.isdigit() for c in core), sum(c.isalpha() for c in core)
    classes = re.sub(r"(.)\1+", r"\1", re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"[0-9]", "9", core)))[:24])
    low = core.lower()
    out = [
        f"words={n_words}",
        f"digits={min(digits, 20)}",
        f"letters={min(4, letters.bit_length())}",
        f"mixed={bool(digits and letters)}",
        f"shape={classes}" if len(classes) <= 12 else "shape=long",
        f"@={core.count('@')}",
        f"dots={min(core.count('.'), 4)}",
        f"plus={core.startswith('+')}",
        f"length={min(7, len(core).bit_length())}",
    ]
    if _HEX.search(core):
        out.append("hex")
    if _CLOUD.search(core):
        out.append(f"cloud&words={n_words}")
    if key := _KEY.match(core):
        rest = core[key.end() :].lstrip(" :=\"'")
        out.append(f"key&value={min(3, len(rest).bit_length())}&mixed={any(c.isdigit() for c in rest)}&sign={'=' in core or ':' in core}&words={n_words}")
    elif _KEY.search(core):
        out.append("key inside")
    if re.fullmatch(r"[\w.+-]+ ?[\[(]?(?:@|at)[\])]? ?[\w-]+(?: ?[\[(]?(?:\.|dot)[\])]? ?[\w-]+)+", low):
        out.append(f"address&spelled={' ' in low}")
    if re.fullmatch(r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}", core):
        out.append("local number")
    if _KEY.search(before):
        out.append("key before")
    return tuple(out)


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Word spans around each telling word, overlapping ones joined."""
    marks: list[tuple[int, int]] = []
    end = -1
    for m in _TELLING.finditer(text):
        if m.start() < end:
            continue
        a, b = m.start(), m.end()
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        end = b
        left, right = a, b
        for _ in range(AROUND):
            while left > 0 and text[left - 1].isspace():
                left -= 1
            while left > 0 and not text[left - 1].isspace():
                left -= 1
            while right < len(text) and text[right].isspace():
                right += 1
            while right < len(text) and not text[right].isspace():
                right += 1
        if marks and left <= marks[-1][1]:
            marks[-1] = (marks[-1][0], right)
        else:
            marks.append((left, right))
    return [[(a + m.start(), a + m.end()) for m in re.finditer(r"\S+", text[a:b])] for a, b in marks]


class Field:
    """A semi-Markov conditional random field with weights for (label, feature) and for neighbouring labels."""

    def __init__(self) -> None:
        self.features: dict[str, int] = {}
        self.weights = np.zeros((0, len(LABELS)))
        self.moves = np.zeros((len(LABELS), len(LABELS)))

    def numbers(self, words: list[str], grow: bool) -> dict[tuple[int, int], list[int]]:
        """Feature numbers of all segments (start, end); "other" segments have one word."""
        out = {}
        for end in range(1, len(words) + 1):
            for start in range(max(0, end - LONGEST), end):
                names = span_features(words[start - 1] if start else "", " ".join(words[start:end]), end - start)
                if grow:
                    for n in names:
                        self.features.setdefault(n, len(self.features))
                out[start, end] = [self.features[n] for n in names if n in self.features]
        return out

    def segment_scores(self, numbers: dict[tuple[int, int], list[int]]) -> dict[tuple[int, int], np.ndarray]:
        out = {}
        for (a, b), f in numbers.items():
            s = self.weights[f].sum(axis=0) if f else np.zeros(len(LABELS))
            if b - a > 1:
                s = s.copy()
                s[0] = -np.inf
            out[a, b] = s
        return out

    def decode(self, words: list[str]) -> list[tuple[int, int, str]]:
        """The best segmentation."""
        scores = self.segment_scores(self.numbers(words, False))
        n, k = len(words), len(LABELS)
        best = np.full((n + 1, k), -np.inf)
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for end in range(1, n + 1):
            for start in range(max(0, end - LONGEST), end):
                came = (best[start][:, None] + self.moves).max(axis=0) if start else np.zeros(k)
                via = (best[start][:, None] + self.moves).argmax(axis=0) if start else np.full(k, -1)
                total = came + scores[start, end]
                for y in np.flatnonzero(total > best[end]):
                    best[end, y] = total[y]
                    back[end, int(y)] = (start, int(via[y]))
        out, end, y = [], n, int(best[n].argmax()) if n else 0
        while end > 0:
            start, before = back[end, y]
            out.append((start, end, LABELS[y]))
            end, y = start, before
        return out[::-1]

    def train(self, sentences: list[tuple[list[str], list[tuple[int, int, int]]]], rounds: int = 30, rate: float = 0.3, decay: float = 0.002) -> Field:
        """Adagrad on the log-likelihood."""
        data = [(self.numbers(w, True), gold, len(w)) for w, gold in sentences]
        k = len(LABELS)
        self.weights = np.zeros((len(self.features), k))
        seen, seen_moves = np.full_like(self.weights, 1e-6), np.full_like(self.moves, 1e-6)
        for _ in range(rounds):
            for numbers, gold, n in data:
                scores = self.segment_scores(numbers)
                forward, backward = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
                step = {}
                for end in range(1, n + 1):
                    for start in range(max(0, end - LONGEST), end):
                        came = np.logaddexp.reduce(forward[start][:, None] + self.moves, axis=0) if start else np.zeros(k)
                        step[start, end] = came
                        forward[end] = np.logaddexp(forward[end], came + scores[start, end])
                backward[n] = 0
                for start in range(n - 1, 0, -1):
                    ahead = np.full(k, -np.inf)
                    for end in range(start + 1, min(n, start + LONGEST) + 1):
                        ahead = np.logaddexp(ahead, scores[start, end] + backward[end])
                    backward[start] = np.logaddexp.reduce(self.moves + ahead[None, :], axis=1)
                total = np.logaddexp.reduce(forward[n])
                change, change_moves = np.zeros_like(self.weights), np.zeros_like(self.moves)
                for (a, b), f in numbers.items():
                    p = np.exp(step[a, b] + scores[a, b] + backward[b] - total)
                    np.add.at(change, f, -p)
                    if a:
                        change_moves -= np.exp(forward[a][:, None] + self.moves + (scores[a, b] + backward[b])[None, :] - total)
                for i, (a, b, y) in enumerate(gold):
                    np.add.at(change, (numbers[a, b], y), 1)
                    if i:
                        change_moves[gold[i - 1][2], y] += 1
                change -= decay * self.weights
                seen += change**2
                seen_moves += change_moves**2
                self.weights += rate * change / np.sqrt(seen)
                self.moves += rate * change_moves / np.sqrt(seen_moves)
        return self


def training_sentences(n: int = 160, seed: int = 5) -> list[tuple[list[str], list[tuple[int, int, int]]]]:
    """Sentences by rule: invented words, harmless numbers, and personal data in several spellings."""
    r = random.Random(seed)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    take = lambda chars, k: "".join(r.choice(chars) for _ in range(k))

    def word() -> str:
        w = take(letters, r.randint(1, 9))
        return r.choice([w, w, w, w.capitalize(), w + ",", w + "."])

    def harmless() -> str:
        return r.choice(
            [
                f"version {take('123456789', 1)}.", f"{r.randint(1, 9)}.{r.randint(0, 9)}.", str(r.randint(1, 9999)), f"{r.randint(1900, 2099)}",
                f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}", f"x = {r.randint(1, 99)}", f"{take(letters, 4)}{r.randint(1, 99)}",
                f"{r.randint(1, 9)},{r.randint(100, 999)}.{r.randint(10, 99)}", "the password is", "token", f"{take(letters, 1)}={take(letters, 3)}",
                f"{r.randint(2000, 2030)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", "at", "dot", "look at", "a secret", f"{r.randint(10, 99)} %", "@", f"@{take(letters, 6)}",
            ]
        )

    def private(kind: str) -> str:
        user, host = take(letters, r.randint(3, 8)) + r.choice(["", "." + take(digits, 2)]), take(letters, r.randint(4, 8)) + r.choice(["", take(digits, 1)])
        a, b, c = take(digits, 3), take(digits, 3), take(digits, 4)
        hex_ = take("0123456789abcdef", r.choice([18, 24, 32, 40]))
        return {
            "email": r.choice([f"{user}@{host}.com", f"{user} at {host} dot com", f"{user} [at] {host} [dot] org", f"{user} (at) {host}.net"]),
            "ip": ".".join(str(r.randint(1, 255)) for _ in range(4)),
            "card": r.choice([f"4{take(digits, 15)}", f"5{take(digits, 3)} {take(digits, 4)} {take(digits, 4)} {take(digits, 4)}"]),
            "phone": r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+44 {a} {b} {c}"]),
            "secret": r.choice(
                ["AKIA" + take("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), f"password={hex_}", f'token = "{hex_}"', f"password: {take(letters + digits, 11)}7",
                 f"api_key={take(letters + letters.upper() + digits, 30)}", f"secret = {hex_}", "AKIA" + take(letters.upper(), 16),
                 f"{r.choice(['password', 'secret'])}: {take(letters, r.randint(9, 16))}", f"secret = {take(letters, r.randint(9, 16))}"]
            ),
        }[kind]

    out = []
    for _ in range(n):
        words: list[str] = []
        gold: list[tuple[int, int, int]] = []
        for _ in range(r.randint(2, 5)):
            what = r.random()
            if what < 0.5:
                kind = r.choice(KINDS)
                piece = (private(kind) + r.choice(["", "", ".", ","])).split(" ")
                gold.append((len(words), len(words) + len(piece), LABELS.index(kind)))
            else:
                piece = (word() if what < 0.75 else harmless()).split(" ")
                gold += [(len(words) + i, len(words) + i + 1, 0) for i in range(len(piece))]
            words += piece
        out.append((words, gold))
    return out


def added_spans(text: str, field: Field, base: list[Span]) -> list[Span]:
    """What the field finds apart from the base spans."""
    out: list[Span] = []
    for stretch in stretches(text):
        words = [text[a:b] for a, b in stretch]
        for start, end, kind in field.decode(words):
            if kind == "other":
                continue
            a, b = stretch[start][0], stretch[end - 1][1]
            while a < b and text[a] in _TRIM and text[a] != "(":
                a += 1
            while a < b and text[b - 1] in _TRIM:
                b -= 1
            failed = kind == "card" and not is_card(text[a:b]) or kind == "ip" and not (_IP.fullmatch(text[a:b]) and is_ip(text[a:b]))
            if a < b and not failed and not any(x < b and a < y for _, x, y in base):
                out.append((kind, a, b))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): counts and list of the base spans, and the list of all."""
    field = Field().train(training_sentences())

    def run(batch: pa.RecordBatch):
        out: list[list] = [[], [], [], [], [], []]
        for t in batch.column(1).to_pylist():
            base = base_spans(t)
            kinds = [k for k, _, _ in base]
            for i, k in enumerate(KINDS[:4]):
                out[i].append(kinds.count(k))
            out[4].append(joined(base))
            out[5].append(joined(base + added_spans(t, field, base)))
        return [batch.column(0), *out]

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return per_batch(rows, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def digests(found: DataFrame) -> DataFrame:
    """The counts, the digest of the base spans and all spans."""
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; a null text stays null."""
    from pyspark.sql.functions import pandas_udf

    field = Field().train(training_sentences())

    @pandas_udf("string")
    def masked(texts):
        def one(t):
            if t is None:
                return None
            base = base_spans(t)
            pieces, at = [], 0
            for kind, a, b in sorted(base + added_spans(t, field, base), key=lambda s: (s[1], s[2])):
                if b <= at:
                    continue
                pieces += [t[at : max(a, at)], f"<{kind}>"]
                at = b
            return "".join([*pieces, t[at:]])

        return texts.map(one)

    return docs.withColumn(text, masked(F.col(text)))
