"""Secrets in text: fixed patterns, and a linear-chain conditional random field on top.

Three patterns give the base spans, leftmost and non-overlapping per kind. The random field
tags every token as outside a secret, its begin or its inside, and Viterbi decoding gives the
best tagging; tagged spans that touch no base span are added under the kind ``crf``.

A token is a run of letters, digits, bytes beyond ASCII and ``_ - + /``, or a run of other
visible characters. Its features are its shape (length, mix of digits and cases, hexadecimal,
vowels), the same of its neighbours, key words up to four tokens before, and features of the
file (how often key words and assignments occur in it). All of them are computed for a
megabyte of text at once.

Decoding is exact: a token whose score for a secret is lower than its score for outside by
more than transitions and the token after it can win back is outside in the best tagging, so
the chain falls apart there; the few runs of other tokens in between are decoded by Viterbi.

The field is trained on lines made by the rules in `training_lines` and on at most
`SAMPLE_ROWS` documents, the smallest by hash of id and text, tagged by the base patterns. They
are cut into parts of `PART_CHARS` characters, of which at most `SAMPLE_PARTS` are taken, so
what the driver sees does not grow with the texts either.

Defined cases: null text counts as empty and has no spans; repeated rows and null ids are
ordinary rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import NOT_SPACE, bytes_of, row_groups, words
from tidemark.llm.tasks import map_batches

KINDS = ("assign", "access", "hex", "crf")
SAMPLE_ROWS = 40
#: Parts of sampled documents that are learnt from, and their characters.
SAMPLE_PARTS, PART_CHARS = 400, 4_000
#: Tokens of a chain in training; longer texts are cut there.
TRAIN_TOKENS = 32

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HEX_BYTES = re.compile(rb"[0-9a-f]{32}")
_KEY_BYTES = (b"password", b"passwd", b"secret", b"token", b"api")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, in order."""
    found = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    # a maximal run of 32 or more is what a longer match of the class would be
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _may_have_base(text: bytes) -> bool:
    low = text.lower()
    return b"AKIA" in text or any(k in low for k in _KEY_BYTES) or _HEX_BYTES.search(text) is not None


# -- features ---------------------------------------------------------------------------------

_WORD = np.zeros(256, np.uint8)
_WORD[[b for b in range(128) if not (chr(b).isalnum() or chr(b) in "_-+/")]] = 1

#: Words that announce a secret.
KEY_WORDS = (
    "password passwd pwd passphrase secret token apikey api_key api-key access_key access-key accesskey secret_key private_key "
    "auth_token access_token refresh_token client_secret credential credentials bearer authorization auth_key signing_key "
    "encryption_key aws_secret_access_key aws_access_key_id db_password secret_access_key"
).split()

_CLASSES = np.zeros((256, 6), np.int32)
_CLASSES[48:58, 0] = 1  # digits
_CLASSES[65:91, 1] = 1  # upper case
_CLASSES[97:123, 2] = 1  # lower case
_CLASSES[[ord(c) for c in "0123456789abcdefABCDEF"], 3] = 1
_CLASSES[[ord(c) for c in "aeiouAEIOU"], 4] = 1
_CLASSES[[ord(c) for c in "_-+/"], 5] = 1

SHAPES = 14
FILE_FEATURES = 3
#: Shape of the token, of the one before and after, key words 1 to 4 back, separator before, file features, bias.
N_FEATURES = 3 * SHAPES + 4 + 1 + FILE_FEATURES + 1


def _hashes_of(names: list[str]) -> np.ndarray:
    data, offsets = bytes_of(pa.array(names))
    hashes, _, _, at = words(data, offsets, NOT_SPACE, _WORD)
    return np.sort(hashes[at[:-1]])


_KEY_HASHES = _hashes_of(list(KEY_WORDS))


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = (ends - starts).astype(np.int32)
    edges = np.empty(2 * len(starts), np.int64)
    edges[0::2], edges[1::2] = starts, ends
    if len(edges) and edges[-1] == len(data):
        edges = edges[:-1]
    counts = [np.add.reduceat(_CLASSES[:, k][data], edges)[0::2] if len(edges) else np.zeros(0, np.int32) for k in range(6)]
    digits, upper, lower, hexa, vowels, marks = counts
    letters = upper + lower
    return np.stack(
        [
            _WORD[data[starts]] == 0 if len(starts) else np.zeros(0, bool),
            n >= 8,
            n >= 16,
            n >= 24,
            n >= 32,
            digits > 0,
            (digits > 0) & (letters > 0),
            (digits >= 3) & (letters >= 3),
            (upper > 0) & (lower > 0) & (digits > 0),
            (hexa == n) & (n >= 12) & (digits > 0),
            (digits == n) & (n >= 4),
            (vowels * 6 < letters) & (letters >= 6),
            (marks > 0) & (digits > 0),
            (upper >= 4) & (lower >= 4),
        ],
        axis=1,
    )


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """Row i of the result is row i - by of `x`, false outside."""
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by]
    elif by < 0:
        out[:by] = x[-by:]
    return out


class Lines:
    """The tokens of several texts with their features; chains are whole texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        hashes, self.starts, self.ends, self.at = words(data, offsets, NOT_SPACE, _WORD)
        shape = _shapes(data, self.starts, self.ends)
        key = np.isin(hashes, _KEY_HASHES)
        text = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        sign = np.zeros(len(hashes), bool)
        if len(hashes):
            first, last = data[self.starts], data[self.ends - 1]
            sign = (shape[:, 0] == 0) & ((first == 61) | (first == 58) | (last == 61) | (last == 58))
        sums = [np.bincount(text[mask], minlength=len(self.at) - 1) for mask in (key, sign, shape[:, 7])]
        files = np.stack([sums[0] > 0, sums[1] >= 5, sums[2] >= 5], axis=1)[text] if len(hashes) else np.zeros((0, 3), bool)
        self.features = [shape[:, k] for k in range(SHAPES)]
        for by in (1, -1):
            near = self._within(shape, text, by)
            self.features += [near[:, k] for k in range(SHAPES)]
        self.features += [self._within(key[:, None], text, k)[:, 0] for k in range(1, 5)]
        self.features += [self._within(sign[:, None], text, 1)[:, 0] | self._within(sign[:, None], text, 2)[:, 0]]
        self.features += [files[:, k] for k in range(FILE_FEATURES)] + [np.ones(len(hashes), bool)]

    @staticmethod
    def _within(x: np.ndarray, text: np.ndarray, by: int) -> np.ndarray:
        """Features of the token `by` places before, false across texts."""
        if len(text) == 0:
            return x
        same = _shifted(text + 1, by) == text + 1
        return _shifted(x, by) & same[:, None]

    def matrix(self) -> np.ndarray:
        return np.stack(self.features, axis=1).astype(np.float64) if len(self.starts) else np.zeros((0, N_FEATURES))


# -- the field --------------------------------------------------------------------------------

OUT, BEGIN, INSIDE = 0, 1, 2
#: A score no tagging can win back: an inside follows a begin or an inside only.
_NEVER = -30.0


class Field:
    """Weights of a linear-chain random field over three tags."""

    def __init__(self):
        self.weights = np.zeros((N_FEATURES, 3))
        self.moves = np.zeros((3, 3))
        self.moves[OUT, INSIDE] = _NEVER
        self.first = np.array([0.0, 0.0, _NEVER])

    def fit(self, x: np.ndarray, tags: np.ndarray, at: np.ndarray, rounds: int = 100, rate: float = 0.08, decay: float = 2e-3) -> None:
        """Maximum likelihood with weight decay; forward and backward over all chains at once."""
        counts = np.diff(at)
        chains, longest = np.flatnonzero(counts), int(counts.max())
        steps = np.full((len(chains), longest), -1)
        for row, chain in enumerate(chains):
            steps[row, : counts[chain]] = np.arange(at[chain], at[chain + 1])
        real = steps >= 0
        gold = np.eye(3)[tags]
        together = np.zeros((3, 3))
        for a, b in zip(steps[:, :-1][real[:, 1:]], steps[:, 1:][real[:, 1:]]):
            together[tags[a], tags[b]] += 1
        first = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        second = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        for turn in range(1, rounds + 1):
            scores = x @ self.weights
            marginal, pairs = self._expected(scores, steps, real)
            slopes = [x.T @ (gold - marginal) / len(chains) - decay * self.weights, (together - pairs) / len(chains)]
            slopes[1][OUT, INSIDE] = 0
            for k, (value, slope) in enumerate(zip((self.weights, self.moves), slopes)):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                value += rate * first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)

    def _expected(self, scores: np.ndarray, steps: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, longest = steps.shape
        padded = np.where(real[:, :, None], scores[steps], 0.0)
        ahead = np.zeros((n, longest, 3))
        ahead[:, 0] = padded[:, 0] + self.first
        for t in range(1, longest):
            best = _sum_out(ahead[:, t - 1, :, None] + self.moves, 1) + padded[:, t]
            ahead[:, t] = np.where(real[:, t, None], best, ahead[:, t - 1])
        total = _sum_out(ahead[:, -1], 1)
        back = np.zeros((n, 3))
        marginal = np.zeros_like(scores)
        pairs = np.zeros((3, 3))
        for t in range(longest - 1, -1, -1):
            live = real[:, t]
            marginal[steps[live, t]] = np.exp(ahead[live, t] + back[live] - total[live, None])
            if t:
                joint = ahead[:, t - 1, :, None] + self.moves + (padded[:, t] + back)[:, None, :] - total[:, None, None]
                pairs += np.exp(joint[live]).sum(axis=0)
                moved = _sum_out(self.moves + (padded[:, t] + back)[:, None, :], 2)
                back = np.where(live[:, None], moved, back)
        return marginal, pairs

    def scores(self, lines: Lines) -> np.ndarray:
        """Scores of all tokens and tags, a feature at a time."""
        n = len(lines.starts)
        out = np.zeros((3, n), np.float32)
        for k, feature in enumerate(lines.features):
            held = feature.astype(np.float32)
            for tag in range(3):
                if self.weights[k, tag]:
                    out[tag] += held * np.float32(self.weights[k, tag])
        return out

    def _reach(self) -> float:
        """The most that transitions lose when a token becomes outside and the next a begin."""
        usual = self.moves[self.moves > _NEVER / 2]
        return 3 * float(usual.max() - usual.min())

    def decode(self, lines: Lines) -> np.ndarray:
        """The best tags of all tokens."""
        scores = self.scores(lines)
        tags = np.zeros(len(lines.starts), np.int8)
        gain = np.maximum(scores[BEGIN], scores[INSIDE]) - scores[OUT]
        # an inside that follows would have to become a begin
        gain[:-1] += np.maximum(0, scores[INSIDE] - scores[BEGIN])[1:]
        open_ = np.flatnonzero(gain + self._reach() > 0)
        if len(open_) == 0:
            return tags
        chain = np.searchsorted(lines.at, open_, "right")
        cuts = np.flatnonzero((np.diff(open_) > 1) | (np.diff(chain) > 0)) + 1
        lo, hi = open_[np.concatenate([[0], cuts])], open_[np.concatenate([cuts - 1, [-1]])] + 1
        edge = np.zeros(len(tags) + 1, bool)
        edge[lines.at] = True
        longest_first = np.argsort(lo - hi, kind="stable")
        self._viterbi(scores, lo[longest_first], hi[longest_first], edge, tags)
        return tags

    def _viterbi(self, scores: np.ndarray, lo: np.ndarray, hi: np.ndarray, edge: np.ndarray, tags: np.ndarray) -> None:
        """Write the best tags of the runs [lo, hi), longest first, all runs a token at a time.

        A run stands between outside tokens or, where `edge` says so, at an end of its text.
        """
        length = hi - lo
        leave = np.where(edge[hi][:, None], 0.0, self.moves[:, OUT])
        best = scores[:, lo].T + np.where(edge[lo][:, None], self.first, self.moves[OUT])
        came, last = [], np.zeros(len(lo), np.int64)
        for t in range(int(length[0])):
            n = int(np.searchsorted(-length, -t, "left"))  # runs with a token t
            if t:
                step = best[:n, :, None] + self.moves
                came.append(step.argmax(axis=1))
                best = step.max(axis=1) + scores[:, lo[:n] + t].T
            done = np.flatnonzero(length[:n] == t + 1)
            last[done] = (best[done] + leave[done]).argmax(axis=1)
        for t in range(int(length[0]) - 1, -1, -1):
            n = int(np.searchsorted(-length, -t, "left"))
            tags[lo[:n] + t] = last[:n]
            if t:
                last[:n] = came[t - 1][np.arange(n), last[:n]]


def _sum_out(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - most).sum(axis=axis, keepdims=True)) + most).squeeze(axis)


# -- training ---------------------------------------------------------------------------------


def training_lines(seed: int = 5) -> list[tuple[str, list[tuple[int, int]]]]:
    """Made lines and the spans of their secrets, by rule."""
    rng = random.Random(seed)
    lower, alnum = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def draw(letters: str, low: int, high: int) -> str:
        return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    def syllables(n: int) -> str:
        return "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") + rng.choice(["", "", "n", "r", "s"]) for _ in range(n))

    def prose(n: int) -> str:
        made = [syllables(rng.randint(1, 4)) for _ in range(n)]
        return " ".join(w.capitalize() if rng.random() < 0.1 else w.upper() if rng.random() < 0.04 else w for w in made)

    def secret() -> str:
        kind = rng.randrange(6)
        if kind == 0:
            return draw("0123456789abcdef", 20, 64)
        if kind == 1:
            return draw(alnum, 16, 44) + str(rng.randrange(10))
        if kind == 2:
            return draw(alnum + "+/", 24, 44) + "7"
        if kind == 3:
            return "AKIA" + draw("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 16)
        if kind == 4:
            return rng.choice(["ghp_", "sk_live_", "xoxb-", "glpat-"]) + draw(alnum, 20, 36) + "9"
        return draw(lower, 4, 6) + draw("0123456789", 3, 5) + draw(alnum, 4, 8)

    lines = []
    for number in range(600):
        before, after = prose(rng.randint(0, 8)), prose(rng.randint(0, 8))
        value = secret()
        if number % 3 == 0:
            key = rng.choice(KEY_WORDS)
            middle = rng.choice([f"{key} = ", f"{key}: ", f'{key}="', f"{key} is ", f"{key} := '", f"{key} "])
            if " is " in middle or middle == f"{key} ":
                value = draw(alnum, 14, 30) + "4x"
            spans = True
        elif number % 3 == 1 and len(value) >= 24:
            middle, spans = "", True
        else:
            middle = ""
            value = rng.choice(
                [
                    draw("0123456789", 4, 19),
                    f"+{draw('123456789', 1, 2)} ({draw('0123456789', 3, 3)}) {draw('0123456789', 3, 3)}-{draw('0123456789', 4, 4)}",
                    f"https://{syllables(2)}.example.com/{syllables(2)}/{rng.randrange(9999)}.html?page={rng.randrange(9)}",
                    f"{syllables(2)}.{syllables(2)}@{syllables(3)}.org",
                    f"20{rng.randint(10, 29)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
                    f"{syllables(3)}-{syllables(2)}{rng.randrange(99)}",
                    syllables(rng.randint(8, 14)),
                    f"{rng.choice(KEY_WORDS)} {prose(3)}",
                    f"{rng.choice(KEY_WORDS)}: {prose(2)}",
                    f"{draw('0123456789', 4, 4)} {draw('0123456789', 4, 4)} {draw('0123456789', 4, 4)} {draw('0123456789', 4, 4)}",
                    f"{syllables(2)}{rng.choice(['###', '***', '$$$', '!!', '&&&'])} {prose(3).upper()}",
                ]
            )
            spans = False
        head = (before + " " if before else "") + middle
        lines.append((f"{head}{value} {after}", [(len(head), len(head) + len(value))] if spans else []))
    return lines


def _sample(docs: DataFrame) -> list[str]:
    """Parts of the sampled documents; tasks choose by hashes, and only the chosen texts are cut and fetched."""
    hashed = docs.where("text IS NOT NULL").select("text", F.xxhash64("doc_id", "text").alias("h"))
    chosen = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_ROWS).collect()]
    texts = hashed.where(F.col("h").isin(chosen))
    numbers = F.sequence(F.lit(0), (F.greatest(F.char_length("text"), F.lit(1)) - 1).cast("int"), F.lit(PART_CHARS))
    parts = texts.select("h", F.explode(numbers).alias("first")).distinct().orderBy(F.xxhash64("h", "first"), "h", "first").limit(SAMPLE_PARTS)
    cut = texts.join(F.broadcast(parts), "h").select("h", "first", F.substr("text", F.col("first") + 1, F.lit(PART_CHARS)).alias("part"))
    return [r["part"] for r in sorted(cut.dropDuplicates(["h", "first"]).collect(), key=lambda r: (r["h"], r["first"]))]


def train(docs: DataFrame) -> Field:
    """A field from the made lines and a bounded sample of `docs` (doc_id, text)."""
    made = training_lines()
    for text in _sample(docs):
        spans = []
        for start, end, kind in base_spans(text):
            m = _ASSIGN.match(text, start) if kind == 0 else None
            spans.append(m.span(2) if m else (start, end))
        made.append((text, spans))
    data, offsets = bytes_of(pa.array([line for line, _ in made]))
    lines = Lines(data, offsets)
    tags = np.zeros(len(lines.starts), np.int64)
    for i, (line, spans) in enumerate(made):
        for start, end in spans:
            lo, hi = (int(offsets[i]) + len(line[:k].encode()) for k in (start, end))
            inside = np.arange(lines.at[i], lines.at[i + 1])
            inside = inside[(lines.starts[inside] >= lo) & (lines.ends[inside] <= hi)]
            tags[inside] = INSIDE
            tags[inside[:1]] = BEGIN
    at = np.unique(np.concatenate([np.arange(lo, hi, TRAIN_TOKENS) for lo, hi in zip(lines.at[:-1], lines.at[1:])] + [lines.at]))
    heads = at[:-1][tags[at[:-1]] == INSIDE]
    tags[heads] = BEGIN
    field = Field()
    field.fit(lines.matrix(), tags, at)
    return field


# -- scanning ---------------------------------------------------------------------------------


def _tagged(lines: Lines, tags: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Spans of tagged tokens by text, in code points."""
    found: dict[int, list[tuple[int, int]]] = {}
    used = np.flatnonzero(tags)
    if len(used) == 0:
        return found
    chain = np.searchsorted(lines.at, used, "right") - 1
    opens = np.flatnonzero((tags[used] == BEGIN) | (np.diff(used, prepend=-2) > 1) | (np.diff(chain, prepend=-1) > 0))
    firsts, lasts = used[opens], used[np.append(opens[1:], len(used)) - 1]
    # code points before each byte, over all texts at once
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    texts = chain[opens]
    origin = points[offsets[texts]]
    for text, start, end in zip(texts.tolist(), (points[lines.starts[firsts]] - origin).tolist(), (points[lines.ends[lasts]] - origin).tolist()):
        found.setdefault(text, []).append((start, end))
    return found


def _apart(added: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The added spans that touch no base span; base spans come by start."""
    starts = [s[0] for s in base]
    # the furthest end of the base spans up to each
    reach = list(itertools.accumulate((s[1] for s in base), max))
    kept = []
    for start, end in added:
        before = bisect_left(starts, end)
        if not before or reach[before - 1] <= start:
            kept.append((start, end, 3))
    return kept


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end, joined) of every row of `docs`."""
    field = docs.sparkSession.sparkContext.broadcast(train(docs))

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            rows: list[tuple[list, list]] = []
            for lo, hi in row_groups(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                texts = [part[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)]
                lines = Lines(part, at)
                tagged = _tagged(lines, field.value.decode(lines), part, at)
                for i, text in enumerate(texts):
                    base = base_spans(text.decode("utf-8", "replace")) if _may_have_base(text) else []
                    added = _apart(tagged.get(i, []), base)
                    rows.append((base, sorted(base + added, key=lambda s: (s[0], s[2]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array([sum(s[2] == kind for s in base) for base, _ in rows], pa.int64()) for kind in range(3)]
                + [
                    pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([_joined(spans) for _, spans in rows], pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, scan_batches, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
