"""Secret scan: fixed rules, and a character convolutional network over every candidate and its context.

The rules find assignments, access keys and hexadecimal strings. Every other token near a credential word,
and elsewhere every long or mixed one, is a candidate; the network sees all its characters and those around
it, and adds it where its calibrated score passes the threshold of its shape. The network is fitted in numpy on findings
that the rules label in a bounded sample of the corpus, on variations of them and, as negatives, on tokens
known to be harmless. A part left out of the fit calibrates the scores, another the thresholds: of each
shape the highest that keeps the wanted recall.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, sample_texts, slices, table, whole_text

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32}")
#: Words that announce a credential, in the languages at hand.
CREDENTIAL = re.compile(r"passw(?:or[dt]|d)|pass(?:phrase|code|key)|pwd|secret|token|(?:api|access|private|auth|secret|signing)[ _-]?key|bearer|credential|auth(?![a-z])|login|kennwort|contrase|clave|mot de passe", re.IGNORECASE)
#: A token beside a credential word, of ``NEAR_LEAST`` characters at least and at most so far behind or before it.
NEAR = re.compile(r"[^\s\"'`<>(){}\[\],;|]+")
NEAR_LEAST, NEAR_AFTER, NEAR_BEFORE = 4, 48, 24
#: A token anywhere else: any of ``LONG`` characters, or a shorter one that mixes kinds of characters.
TOKEN = re.compile(r"[!#-&*+\--:=?-Z\\^_a-z~]{8,}")
LONG = 16
MIXED = re.compile(r"[A-Za-z].*[0-9!@#$%^&*+=~]|[0-9!@#$%^&*+=~].*[A-Za-z]|[a-z][A-Z]")
MARKS = "!#$%&*.,:?~=-"
HARMLESS_NUMBER = re.compile(r"[0-9][0-9:/_.,-]*")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Documents of the sample from which findings are taken, those of the smallest hashed doc_id.
FIT_DOCUMENTS = 3000
RECALL = 0.98
BEFORE, HEAD, TAIL, AFTER = 24, 40, 16, 8
WINDOW = BEFORE + HEAD + TAIL + AFTER
WIDTH, EMBED, FILTERS = 5, 8, 32
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ =:\"'+/_-.,@()<>{}[]#$%&*!?|;\n"
_CODE = {c: i + 2 for i, c in enumerate(_ALPHABET)}  # 0 is padding, 1 any other character
_INSIDE = len(_CODE) + 2  # characters of the candidate have codes of their own
CODES = 2 * _INSIDE

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of what the rules find, leftmost and non-overlapping in each kind, too short ones dropped."""
    raw = text.encode("utf-8", "surrogatepass")
    found: list[Span] = []
    low = raw.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if LONG_HEX.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(found)


def _near(text: str) -> list[Span]:
    """Regions beside credential words, overlapping ones joined, as (start, 0, end)."""
    found: list[Span] = []
    for m in CREDENTIAL.finditer(text):
        start, end = max(0, m.start() - NEAR_BEFORE), m.end() + NEAR_AFTER
        if found and start <= found[-1][2]:
            found[-1] = (found[-1][0], 0, end)
        else:
            found.append((start, 0, end))
    return found


def _value(text: str, start: int, end: int) -> Span:
    """A token without the name that it is assigned to, if that is a credential word, and without closing marks."""
    m = re.compile(r"[^:=]*[:=]+").match(text, start, end)
    if m and CREDENTIAL.search(m[0]):
        start = m.end()
    while end > start and text[end - 1] in ".,:?":
        end -= 1
    return start, 0, end


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Tokens near a credential word, and long or mixed ones anywhere, that no rule's span touches."""
    found: set[tuple[int, int]] = set()
    for left, _, right in _near(text):
        while left > 0 and NEAR.match(text[left - 1]):  # whole tokens only
            left -= 1
        for m in NEAR.finditer(text, left):
            if m.start() >= right:
                break
            start, _, end = _value(text, *m.span())
            if end - start >= NEAR_LEAST and not CREDENTIAL.fullmatch(text, start, end):
                found.add((start, end))
    for m in TOKEN.finditer(text):
        if len(m[0]) < LONG and not MIXED.search(m[0]):
            continue
        start, _, end = _value(text, *m.span())
        if end - start >= LONG or end - start >= 8 and MIXED.search(text[start:end].strip(MARKS)):
            found.add((start, end))
    out: list[tuple[int, int]] = []
    spans, at, reach = sorted(taken), 0, -1  # reach: the farthest end of the rules' spans that begin before a candidate's end
    for start, end in sorted(found, key=lambda c: (c[0], -c[1])):
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= start and (not out or out[-1][1] <= start):
            out.append((start, end))
    return out


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the window around a candidate; the middle of a longer one is left out of its window."""
    token = text[start:end]
    token = token if len(token) <= HEAD + TAIL else token[:HEAD] + token[-TAIL:]
    before = text[max(0, start - BEFORE) : start]
    out = np.zeros(WINDOW, dtype=np.int64)
    row = [_CODE.get(c, 1) for c in before] + [_INSIDE + _CODE.get(c, 1) for c in token] + [_CODE.get(c, 1) for c in text[end : end + AFTER]]
    out[BEFORE - len(before) : BEFORE - len(before) + len(row)] = row
    return out


def encode_whole(text: str, start: int, end: int) -> list[np.ndarray]:
    """Codes of a candidate and its context in windows that overlap so that every position of the convolution is in one."""
    if end - start <= HEAD + TAIL:
        return [encode(text, start, end)]
    row = [_CODE.get(c, 1) for c in text[max(0, start - BEFORE) : start]] + [_INSIDE + _CODE.get(c, 1) for c in text[start:end]] + [_CODE.get(c, 1) for c in text[end : end + AFTER]]
    out = []
    for i in range(0, len(row) - WIDTH + 1, WINDOW - WIDTH + 1):
        piece = row[i : i + WINDOW]
        out.append(np.array(piece + [0] * (WINDOW - len(piece)), dtype=np.int64))
    return out


SHAPES = ("hex", "mixed", "letters")


def shape(token: str) -> int:
    """Hexadecimal digits; letters and signs alone; or mixed with digits."""
    if re.fullmatch(r"[0-9a-fA-F-]{8,}", token):
        return 0
    return 1 if any(c.isdigit() for c in token) else 2


@dataclass
class Network:
    embed: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    out: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, ...] = (0.5, 0.5, 0.5)

    def finds(self, text_places: list[tuple[str, int, int]]) -> np.ndarray:
        """Whether each candidate is a secret."""
        least = np.array([self.thresholds[shape(t[s:e])] for t, s, e in text_places])
        return self.score_whole(text_places) >= least

    def _forward(self, codes: np.ndarray):
        e = self.embed[codes]
        windows = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1)  # n, positions, EMBED, WIDTH
        flat = windows.reshape(len(codes), -1, EMBED * WIDTH)
        h = flat @ self.conv + self.conv_bias
        top = h.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(h, top[:, None, :], 1)[:, 0], 0)
        return flat, top, pooled, pooled @ self.out + self.bias

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self.score_pooled(self.pooled(codes))

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(codes[i : i + 256])[2] for i in range(0, len(codes), 256)])

    def score_whole(self, text_places: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated probabilities of candidates, each seen whole."""
        scores, windows, starts = [], [], []

        def flush() -> None:
            if windows:
                scores.append(self.score_pooled(np.maximum.reduceat(self.pooled(np.array(windows)), starts, axis=0)))
                windows.clear()
                starts.clear()

        for place in text_places:
            starts.append(len(windows))
            windows += encode_whole(*place)
            if len(windows) >= 256:
                flush()
        flush()
        return np.concatenate(scores)

    def score_pooled(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30)))


#: Names of credentials that variations have.
NAMES = ("pwd", "passphrase", "auth_token", "client_secret", "private_key", "access_key", "bearer", "credential", "apikey", "secret_key", "password", "token")


def _varied(rng: random.Random, texts: list[str], names: tuple[str, ...] = NAMES) -> list[tuple[str, int, int, int]]:
    """Findings in other words, and tokens that are none, in contexts from the corpus: (text, start, end, label)."""
    hexes, letters = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    word = lambda: rng.choice(rng.choice(texts).split() or ["a"])[:20]
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    rows = []
    for _ in range(900):
        secret = rng.choice((lambda: pick(hexes, rng.randint(18, 40)), lambda: pick(letters + "+/", rng.randint(20, 44)), lambda: rng.choice(("ghp_", "sk-", "xoxb-", "AKIA")) + pick(letters, rng.randint(20, 36))))()
        name = rng.choice(names) if rng.random() < 0.7 else word()  # long random strings are secrets beside any word
        lead = f"{word()} {name}{rng.choice((' = ', '=', ': ', '=\"', ': \"'))}"
        text = f"{lead}{secret} {word()}"
        rows.append((text, len(lead), len(lead) + len(secret), 1))
        number = rng.choice((
            lambda: pick("0123456789", rng.randint(16, 19)),
            lambda: "-".join(pick("0123456789", 4) for _ in range(4)),
            lambda: f"{rng.randint(1990, 2030)}-{pick('0123456789', 2)}-{pick('0123456789', 2)}_{pick('0123456789', 6)}",
            lambda: f"{word()}/{word()}/{rng.randint(1, 999)}/{word()}",
            lambda: f"{word()}-{word()}-{word()}-{rng.randint(1, 99)}",
            lambda: f"version-{rng.randint(1, 9)}-{rng.randint(0, 99)}-release",
            lambda: f"{word()}{word()}{word()}{rng.randint(1, 9)}",
        ))()
        lead = f"{word()} {word()} "
        rows.append((f"{lead}{number} {word()}", len(lead), len(lead) + len(number), 0))
        secret = rng.choice((
            lambda: pick(letters, rng.randint(6, 15)) + pick("0123456789", 2),
            lambda: pick(letters, rng.randint(3, 8)) + rng.choice("!@#$%.&*") + pick(letters, rng.randint(3, 8)),
            lambda: pick(letters[:52], rng.randint(12, 40)),
            lambda: word().capitalize() + pick("0123456789", rng.randint(1, 4)) + rng.choice(("", "!", "#", "$")),
            *[lambda: rng.choice("--_.").join(word().strip(MARKS) for _ in range(rng.randint(3, 5)))] * 3,
        ))()
        lead = f"{word()} {rng.choice(names)}{rng.choice((' = ', '=', ': ', '=\"', ' is ', ': '))}"
        rows.append((f"{lead}{secret} {word()}", len(lead), len(lead) + len(secret), 1))
        plain = rng.choice((word, word, lambda: word() + word()))()
        lead = f"{word()} {rng.choice(names)} {rng.choice(('', word() + ' ', 'is ', 'was ', 'for '))}"
        rows.append((f"{lead}{plain} {word()}", len(lead), len(lead) + len(plain), 0))
    return rows


def harmless(token: str, documents: int) -> bool:
    """Whether a token is known to be no secret: a number or date, or a plain word that at least three documents have."""
    return bool(HARMLESS_NUMBER.fullmatch(token)) or documents >= 3 and token.isalpha() and (token.islower() or token[1:].islower())


def train(texts: list[str], recall: float = RECALL, epochs: int = 8, seed: int = 11) -> Network:
    """Fit on what the rules label in ``texts`` and on variations; calibrate on a left-out tenth and choose thresholds on another."""
    rng = random.Random(seed)
    rows = _varied(rng, [t for t in texts if t.strip()] or ["text"])
    counts = Counter(w for t in texts for w in {t[s:e] for s, e in candidates(t, [])})
    for t in texts:
        base = base_spans(t)
        for start, kind, end in base:
            if kind == 0:
                start = end - len(ASSIGN.match(t, start)[2])
            rows.append((t, start, end, 1))
        rows += [(t, s, e, 0) for s, e in candidates(t, base) if harmless(t[s:e], counts[t[s:e]])]
    rng.shuffle(rows)
    first, second = len(rows) * 8 // 10, len(rows) * 9 // 10
    windows = [(w, label) for t, s, e, label in rows[:first] for w in encode_whole(t, s, e)]  # of a long token all windows
    codes, labels = np.array([w for w, _ in windows]), np.array([label for _, label in windows], dtype=float)
    cut = len(windows)
    gen = np.random.default_rng(seed)
    params = {"embed": gen.normal(0, 0.3, (CODES, EMBED)), "conv": gen.normal(0, 0.2, (EMBED * WIDTH, FILTERS)), "conv_bias": np.zeros(FILTERS), "out": gen.normal(0, 0.3, FILTERS), "bias": np.zeros(1)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    net = lambda: Network(params["embed"], params["conv"], params["conv_bias"], params["out"], float(params["bias"][0]))
    for _ in range(epochs):
        for part in np.array_split(gen.permutation(cut), max(1, cut // 64)):
            flat, top, pooled, z = net()._forward(codes[part])
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            back = error[:, None] * params["out"] * (pooled > 0)
            chosen = np.take_along_axis(flat[:, :, None, :], top[:, None, :, None], 1)[:, 0]  # n, FILTERS, EMBED * WIDTH
            grads = {"out": pooled.T @ error, "bias": np.array([error.sum()]), "conv_bias": back.sum(0), "conv": np.einsum("nfk,nf->kf", chosen, back), "embed": np.zeros_like(params["embed"])}
            inner = (back[:, :, None] * params["conv"].T).reshape(len(part), FILTERS, EMBED, WIDTH)
            for k in range(WIDTH):
                np.add.at(grads["embed"], np.take_along_axis(codes[part], top + k, 1), inner[:, :, :, k])
            step += 1
            for name, g in grads.items():
                m, v = moments[name]
                m[:] = 0.9 * m + 0.1 * g
                v[:] = 0.999 * v + 0.001 * g * g
                params[name] = params[name] - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    found = net()
    places, y = [r[:3] for r in rows[first:second]], np.array([r[3] for r in rows[first:second]], dtype=float)
    raw = found.score_whole(places)
    z = np.log(raw / (1 - raw))
    slope, shift = 1.0, 0.0
    for _ in range(200):  # Platt scaling
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        slope -= 0.1 * float(((p - y) * z).mean())
        shift -= 0.1 * float((p - y).mean())
    found.slope, found.shift = slope, shift
    held = [r for r in rows[second:] if r[3]]
    scores, shapes = found.score_whole([r[:3] for r in held]), np.array([shape(r[0][r[1] : r[2]]) for r in held])
    least = lambda own: float(np.sort(own)[int((1 - recall) * len(own))]) if len(own) else 0.5
    found.thresholds = tuple(least(scores[shapes == k] if (shapes == k).sum() >= 20 else scores) for k in range(len(SHAPES)))
    return found


def _scanned(batches: Iterator[pa.RecordBatch], network: Network) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        base = [base_spans(t) for t in texts]
        places = [(i, start, end) for i, t in enumerate(texts) for start, end in candidates(t, base[i])]
        every = [list(b) for b in base]
        if places:
            found = network.finds([(texts[i], s, e) for i, s, e in places])
            for (i, start, end), secret in zip(places, found, strict=True):
                if secret:
                    every[i].append((start, 3, end))
        said = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        count = lambda k: pa.array([sum(x[1] == k for x in b) for b in base], pa.int64())
        digest = [hashlib.sha256(said(b).encode()).hexdigest() for b in base]
        yield pa.RecordBatch.from_arrays([batch.column(0), count(0), count(1), count(2), pa.array(digest), pa.array([said(b) for b in every])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def fitted(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Network:
    """The network for these documents, fitted on at most ``fit_documents`` of them."""
    return train(sample_texts(docs, fit_documents))


def scan(docs: DataFrame, network: Network) -> DataFrame:
    """Secrets in every whole text; one row per input row: doc_id, n_assign, n_access, n_hex, base_sha256 and spans.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then kind in the order assign, access,
    hex, model; base_sha256 is the digest of the same list without the network's spans. A null or empty text
    has none. Rows may repeat, texts may be very long; other columns are ignored. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lambda it: _scanned(it, network), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fitted(docs))
