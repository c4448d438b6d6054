"""Secret scans: base patterns, and a linear-chain conditional random field that adds spans.

The field tags runs of secret characters as begin, inside or outside of a secret, from their
shape, their neighbours, the signs between them and the file they stand in, and is decoded by Viterbi.
It is trained here, on windows of a bounded sample of documents: places that the base patterns
find are secrets, and further secrets of common kinds, of one run and of several, are planted
beside neighbours of common kinds.
"""

from __future__ import annotations

import hashlib
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import (
    IS_SPACE,
    Batches,
    fused,
    joined_bytes,
    lowered,
    mixed,
    pieces,
    prefix_hash,
    same_rows,
    sample_ids,
    span_hash,
    words,
)

#: Documents from which training windows are taken.
SAMPLE_DOCS = 1_000
#: Tokens of a training window, and windows taken of one document.
WINDOW_TOKENS = 24
WINDOWS_PER_DOC = 4
EPOCHS = 12
#: Width of the table of feature weights.
SLOTS = 1 << 15

# Fixed values of the base patterns, in the order in which their spans are listed.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "field")

#: Bytes of a token: what a secret may hold, and letters beyond ASCII.
IS_TOKEN = np.zeros(256, dtype=bool)
IS_TOKEN[[*b"+/_.=-", *string.ascii_letters.encode(), *string.digits.encode()]] = True
IS_TOKEN[128:] = True

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
_NEVER = -1e4


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base matches that are long enough, in code points."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # a run of hex digits is matched whole, so the short ones can be passed over
    out += [(m.start(), m.end(), 2) for m in _LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


_LONG_HEX = re.compile(r"[0-9a-f]{24,}")


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature codes of every token, one column per feature: shape, neighbours, file."""
    n = len(starts)
    lower = lowered(data)
    size = ends - starts

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(mask, out=total[1:])
        return total[ends] - total[starts]

    kind = _CLASS[data]
    digit, upper, letter, high = (count(kind == k) for k in (1, 2, 3, 4))
    change = count(np.concatenate([[False], kind[1:] != kind[:-1]]))
    in_hex = count(_HEX_BYTE[data])
    other = size - digit - upper - letter - high

    log_size = np.minimum(np.log2(np.maximum(size, 1)) * 2, 15).astype(np.int64)
    mask = (digit > 0) * 1 + (upper > 0) * 2 + (letter > 0) * 4 + (high > 0) * 8 + (other > 0) * 16
    part = (8 * digit // np.maximum(size, 1)).astype(np.int64)
    turns = np.minimum(8 * change // np.maximum(size, 1), 8).astype(np.int64)
    shape = (mask * 16 + log_size).astype(np.int64)
    is_hex = (in_hex == size) * 1

    name = (span_hash(prefix_hash(lower), starts, np.minimum(ends, starts + 24)) >> np.uint64(40)).astype(np.int64)
    # only short tokens are names; long ones would be learned by heart
    name = np.where(size <= 12, name, 1)
    head = (span_hash(prefix_hash(data), starts, np.minimum(ends, starts + 4)) >> np.uint64(40)).astype(np.int64)
    head = np.where((digit > 0) & (size >= 12), head, 0)

    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    tokens = np.maximum(np.diff(first), 1)
    mixed_share = np.add.reduceat(np.concatenate([(digit > 0) & (size > 5), [0]]), np.minimum(first[:-1], n))
    file = np.minimum(np.log2(tokens), 15).astype(np.int64) * 4 + np.minimum(4 * mixed_share // tokens, 3)

    def near(values: np.ndarray, step: int) -> np.ndarray:
        """The value `step` tokens further on, or -1 beyond the text."""
        out = np.full(n, -1, dtype=np.int64)
        if abs(step) < n:
            if step > 0:
                out[:-step] = np.where(row[step:] == row[:-step], values[step:], -1)
            else:
                out[-step:] = np.where(row[:step] == row[-step:], values[:step], -1)
        return out

    # what stands between a token and the one before, at most its last four bytes
    inner = np.append(False, row[1:] == row[:-1])[:n]
    since = np.where(inner, np.append(0, ends[:-1])[:n], starts)
    gap = (span_hash(prefix_hash(data), np.maximum(since, starts - 4), starts) >> np.uint64(40)).astype(np.int64)
    gap = np.where(inner, gap, 0)
    total = np.append(0, np.cumsum(IS_SPACE[data]))
    apart = np.where(inner, 1 + (total[starts] > total[since]) * 4 + np.minimum(starts - since, 4) - 1, 0)

    columns = [
        np.zeros(n, dtype=np.int64),
        shape,
        (part * 16 + turns) * 16 + log_size,
        is_hex * 16 + log_size,
        head,
        near(name, -1),
        near(name, -2),
        near(name, 1),
        near(shape, -1),
        near(shape, 1),
        file[row] * 32 + mask if n else np.zeros(0, dtype=np.int64),
        gap,
        near(gap, 1),
        apart,
        near(apart, 1),
        apart * 1024 + mask,
    ]
    out = np.empty((n, len(columns)), dtype=np.int64)
    for k, values in enumerate(columns):
        out[:, k] = mixed((values + 2).astype(np.uint64) * np.uint64(32) + np.uint64(k)) >> np.uint64(40)
    return out & (SLOTS - 1)


_CLASS = np.zeros(256, dtype=np.int8)
_CLASS[48:58] = 1
_CLASS[65:91] = 2
_CLASS[97:123] = 3
_CLASS[128:] = 4
_HEX_BYTE = np.zeros(256, dtype=bool)
_HEX_BYTE[[*b"0123456789abcdef"]] = True


@dataclass(frozen=True)
class Field:
    """Weights by feature slot and tag, and of the steps from tag to tag."""

    weight: np.ndarray
    step: np.ndarray

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), 3), dtype=np.float32)
        for k in range(codes.shape[1]):
            out += self.weight[codes[:, k]]
        return out

    def tags(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best tags of every text by Viterbi, all texts in step, the longest first."""
        score = self.emissions(codes)
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = first[:-1][order], sizes[order]
        back = np.zeros((len(score), 3), dtype=np.int8)
        best = np.zeros((len(order), 3), dtype=np.float32)
        longest = int(sizes[0]) if len(sizes) else 0
        live_at = np.searchsorted(-sizes, -np.arange(longest), side="left")
        for t in range(longest):
            live = int(live_at[t])
            at = begin[:live] + t
            if t == 0:
                best[:live] = score[at] + _START
                continue
            paths = best[:live, :, None] + self.step[None]
            pick = paths.argmax(axis=1)
            back[at] = pick
            best[:live] = np.take_along_axis(paths, pick[:, None, :], axis=1)[:, 0] + score[at]
        tags = np.zeros(len(score), dtype=np.int8)
        now = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            live = int(live_at[t])
            at = begin[:live] + t
            tags[at] = now[:live]
            now[:live] = back[at, now[:live]]
        return tags


_START = np.array([0, 0, _NEVER], dtype=np.float32)


def _planted(rng: np.random.Generator, words: list[str]) -> tuple[list[str], list[int]]:
    """Words with a secret of a common kind among them; the tags of the words put in.

    A word holds what stands before it, as in the windows.
    """

    def draw(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(alphabet), int(rng.integers(low, high))))

    alnum = string.ascii_letters + string.digits
    hexes = "0123456789abcdef"
    kinds = [
        lambda: ["AKIA" + draw(string.ascii_uppercase + string.digits, 16, 17)],
        lambda: [str(rng.choice(["ghp_", "gho_", "ghs_"])) + draw(alnum, 36, 37)],
        lambda: [str(rng.choice(["sk_live_", "rk_live_", "pk_live_"])) + draw(alnum, 24, 33)],
        lambda: [f"xoxb-{draw(string.digits, 10, 13)}-{draw(alnum, 20, 26)}"],
        lambda: ["eyJ" + draw(alnum, 17, 34) + ".eyJ" + draw(alnum, 20, 60) + "." + draw(alnum + "-_", 30, 44)],
        lambda: ["AIza" + draw(alnum + "-_", 35, 36)],
        lambda: [draw(hexes, 32, 65)],
        lambda: [draw(hexes.upper(), 32, 65)],
        lambda: [draw(alnum + "+/", 32, 65)],
    ]
    names = ["token", "secret", "key", "apikey", "api_key", "password", "passwd", "auth", "Bearer", "credentials"]

    def password() -> list[str]:
        """Parts with signs between them."""
        parts = [draw(alnum, 1, 3 if rng.random() < 0.5 else 10) for _ in range(int(rng.integers(2, 6)))]
        parts[0] = draw(string.ascii_letters, 1, 3) + draw(alnum, 3, 9)
        return [parts[0], *(draw("!@#$%^&*~", 1, 3) + x for x in parts[1:])]

    def address() -> list[str]:
        """A connection string with a password."""
        scheme = str(rng.choice(["postgres", "postgresql", "mysql", "mongodb", "redis", "amqp", "https", "ftp"]))
        user, own = draw(string.ascii_lowercase, 3, 9), password() if rng.random() < 0.6 else [draw(alnum, 6, 20)]
        host = str(rng.choice(["db", "localhost", "10.0.0.5", "db.example.com", "cache.internal"]))
        port = [f":{rng.integers(1000, 9999)}/{draw(string.ascii_lowercase, 2, 8)}"] if rng.random() < 0.6 else []
        return [scheme, "://" + user, ":" + own[0], *own[1:], "@" + host, *port]

    def block() -> list[str]:
        """A block of a private key."""
        kind = [[" RSA"], [" EC"], [" OPENSSH"], []][int(rng.integers(4))]
        around = [*kind, " PRIVATE", " KEY-----"]
        lines = ["\n" + draw(alnum + "+/", 64, 65) for _ in range(int(rng.integers(1, 8)))]
        return ["-----BEGIN", *around, *lines, "\n" + draw(alnum + "+/", 10, 64) + "==", "\n-----END", *around]

    choice = rng.random()
    lead: list[str] = []
    if choice < 0.25:
        secret = password()
        sign = str(rng.choice([" =", "=", ":", ": ", '="', '": "']))
        lead = [" " + str(rng.choice(names))]
        if sign == " =":
            lead, secret[0] = [*lead, sign], " " + secret[0]
        elif "=" in sign and '"' not in sign:
            lead, secret[0] = [], lead[0] + sign + secret[0]
        elif "=" in sign:
            lead, secret[0] = [lead[0] + "="], '"' + secret[0]
        else:
            secret[0] = sign + secret[0]
    elif choice < 0.45:
        secret = address() if choice < 0.35 else block()
        secret[0] = " " + secret[0]
    else:
        secret = [" " + x for x in kinds[int(rng.integers(len(kinds)))]()]
        if rng.random() < 0.7:
            lead = [" " + str(rng.choice(names))] + ([" ="] if rng.random() < 0.6 else [])
        if lead and rng.random() < 0.25:
            secret = [" " + draw(alnum + "-_", 10, 24) + str(rng.integers(10, 99))]
    place = int(rng.integers(len(words) + 1))
    after = words[place:]
    if after and after[0][:1] not in (" ", "\n", "\t"):
        after = [" " + after[0], *after[1:]]
    out = words[:place] + lead + secret + after
    tags = [OUTSIDE] * len(out)
    begin = place + len(lead)
    tags[begin : begin + len(secret)] = [BEGIN] + [INSIDE] * (len(secret) - 1)
    return out, tags


def _decoy(rng: np.random.Generator, words: list[str]) -> list[str]:
    """Words with something among them that resembles a secret and is none."""
    digits = "".join(rng.choice(list(string.digits), int(rng.integers(4, 20))))
    plain = [x for word in words for x in _TOKEN.findall(word)]
    kinds = [
        digits,
        "-".join(digits[k : k + 4] for k in range(0, len(digits), 4)),
        "".join(rng.choice(plain, 3)) if plain else "word",
        f"https//www.example.org/{'-'.join(rng.choice(plain, 3)) if plain else 'page'}.html",
        f"{rng.integers(1900, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}",
        str(rng.choice(["token", "secret", "password", "key", "api_key"])),
    ]
    place = int(rng.integers(len(words) + 1))
    after = words[place:]
    if after and after[0][:1] not in (" ", "\n", "\t"):
        after = [" " + after[0], *after[1:]]
    return words[:place] + [" " + kinds[int(rng.integers(len(kinds)))]] + after


def train(windows: list[tuple[list[str], list[int]]], epochs: int = EPOCHS, seed: int = 11) -> Field:
    """Weights that maximise the likelihood of the tags, by adaptive gradient steps."""
    windows = [w for w in windows if w[0]]
    if not windows:
        return Field(np.zeros((SLOTS, 3), np.float32), np.zeros((3, 3), np.float32))
    long = max(len(w) for w, _ in windows)
    gold = np.zeros((len(windows), long), dtype=np.int64)
    live = np.zeros((len(windows), long), dtype=bool)
    data, offsets = joined_bytes(pa.array(["".join(w) for w, _ in windows]))
    starts, ends, first = words(data, offsets, IS_TOKEN)
    found = _codes(data, starts, ends, first)
    codes = np.zeros((len(windows), long, found.shape[1]), dtype=np.int64)
    for k, (tokens, tags) in enumerate(windows):
        own = found[first[k] : first[k + 1]]
        n = min(len(own), len(tokens))
        codes[k, :n], gold[k, :n], live[k, :n] = own[:n], tags[:n], True
    weight = np.zeros((SLOTS, 3))
    step = np.zeros((3, 3))
    step[OUTSIDE, INSIDE] = _NEVER
    fixed = step == _NEVER
    seen_w, seen_s = np.full_like(weight, 1e-6), np.full_like(step, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // 512)):
            grad_w, grad_s = _gradient(weight, step, codes[pick], gold[pick], live[pick])
            grad_w -= 1e-5 * weight
            grad_s[fixed] = 0
            seen_w += grad_w**2
            seen_s += grad_s**2
            weight += 0.3 * grad_w / np.sqrt(seen_w)
            step += 0.3 * grad_s / np.sqrt(seen_s)
    return Field(weight.astype(np.float32), step.astype(np.float32))


def _gradient(weight, step, codes, gold, live):
    """Gradient of the mean log-likelihood, by the forward and backward sums of all windows."""
    n, long, _ = codes.shape
    score = weight[codes].sum(axis=2)
    score = np.where(live[..., None], score, 0.0)

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    ahead = np.zeros((n, long, 3))
    ahead[:, 0] = score[:, 0] + _START
    for t in range(1, long):
        moved = log_sum(ahead[:, t - 1, :, None] + step, 1) + score[:, t]
        ahead[:, t] = np.where(live[:, t, None], moved, ahead[:, t - 1])
    back = np.zeros((n, long, 3))
    for t in range(long - 2, -1, -1):
        moved = log_sum(step[None] + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(live[:, t + 1, None], moved, back[:, t + 1])
    total = log_sum(ahead[:, -1], 1)[:, None, None]
    belief = np.exp(np.minimum(ahead + back - total, 0)) * live[..., None]
    target = np.zeros_like(belief)
    np.put_along_axis(target, gold[..., None], 1.0, axis=2)
    diff = (target * live[..., None] - belief) / n
    grad_w = np.zeros_like(weight)
    for k in range(codes.shape[2]):
        np.add.at(grad_w, codes[:, :, k].ravel(), diff.reshape(-1, 3))
    grad_s = np.zeros_like(step)
    for t in range(1, long):
        both = live[:, t]
        if both.any():
            pair = ahead[both, t - 1, :, None] + step + (score[both, t] + back[both, t])[:, None, :] - total[both]
            grad_s -= np.exp(np.minimum(pair, 0)).sum(axis=0) / n
            np.add.at(grad_s, (gold[both, t - 1], gold[both, t]), 1.0 / n)
    return grad_w, grad_s


def _windows(text_column: str):
    """Step: windows of tokens of each text, as lists, with the tags that the base patterns give."""

    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, text_column):
            out_tokens, out_tags = [], []
            for text in batch.column(text_column).to_pylist():
                tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text or "")]
                if not tokens:
                    continue
                begins = np.array([a for a, _ in tokens])
                tags = [OUTSIDE] * len(tokens)
                centres = []
                for a, b, kind in base_spans(text):
                    # of an assignment, the secret is what follows the sign
                    k = int(np.searchsorted(begins, b, side="left")) - 1
                    if k >= 0 and tokens[k][0] >= a:
                        tags[k] = BEGIN
                        centres.append(k)
                        # a password goes on behind signs
                        while kind == 0 and k + 1 < len(tokens) and _GOES_ON.fullmatch(text, tokens[k][1], tokens[k + 1][1]):
                            k += 1
                            tags[k] = INSIDE
                rng = np.random.default_rng(len(text))
                centres = centres[:WINDOWS_PER_DOC] + rng.integers(0, len(tokens), WINDOWS_PER_DOC).tolist()
                for centre in centres:
                    low = max(0, min(centre - WINDOW_TOKENS // 2, len(tokens) - WINDOW_TOKENS))
                    own = slice(low, low + WINDOW_TOKENS)
                    # every token with what stands before it
                    since = [tokens[low - 1][1] if low else 0, *(b for _, b in tokens[own])]
                    out_tokens.append([text[max(c, a - 8) : a] + text[a:b][:200] for c, (a, b) in zip(since, tokens[own], strict=False)])
                    out_tags.append(tags[own])
            yield pa.record_batch(
                [pa.array(out_tokens, pa.list_(pa.string())), pa.array(out_tags, pa.list_(pa.int32()))],
                names=["tokens", "tags"],
            )

    return step


_GOES_ON = re.compile(r"[!@#$%^&*~]{1,3}[A-Za-z0-9+/_.-]+")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=\-\u0080-\U0010ffff]+")


def fit(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_docs: int = SAMPLE_DOCS
) -> Field:
    """The field, trained on windows of at most `sample_docs` documents, the first by hash of the id."""
    ids = sample_ids(docs, id_column, sample_docs)
    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    chosen = chosen.join(F.broadcast(ids), "_id", "left_semi")
    rows = fused(chosen, ["_text"], [_windows("_text")], "tokens array<string>, tags array<int>")
    found = rows.orderBy(F.xxhash64("tokens")).limit(4 * 2 * sample_docs).collect()
    rng = np.random.default_rng(5)
    windows = []
    for row in found:
        windows.append((list(row["tokens"]), list(row["tags"])))
        if BEGIN not in row["tags"]:
            if rng.random() < 0.7:
                windows.append(_planted(rng, list(row["tokens"])))
            if rng.random() < 0.4:
                words = _decoy(rng, list(row["tokens"]))
                windows.append((words, [OUTSIDE] * len(words)))
    return train(windows)


def _outside(text: str, a: int, b: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What the spans, in order of start, leave of a range; parts of blanks and signs alone are dropped."""
    out = []
    for x, y, _ in [*spans, (b, b, 0)]:
        if y <= a and x < b:
            continue
        if x > a and any(c.isalnum() for c in text[a : min(x, b)]):
            out.append((a, min(x, b)))
        a = max(a, y)
        if a >= b:
            break
    return out


def _scanning(field: Broadcast, id_column: str, text_column: str):
    """Step: the spans of every text as (start, end, kind), in code points."""

    def step(batches: Batches) -> Batches:
        model: Field = field.value
        for batch in pieces(batches, text_column):
            texts = batch.column(text_column)
            data, offsets = joined_bytes(texts)
            starts, ends, first = words(data, offsets, IS_TOKEN)
            tags = model.tags(_codes(data, starts, ends, first), first)
            marked = np.flatnonzero(tags)
            row_of = np.searchsorted(first[1:], marked, side="right")
            added: dict[int, list[list[int]]] = {}
            for k, r in zip(marked.tolist(), row_of.tolist(), strict=True):
                own = added.setdefault(r, [])
                a, b = int(starts[k] - offsets[r]), int(ends[k] - offsets[r])
                if tags[k] == INSIDE and own:
                    own[-1][1] = b
                else:
                    own.append([a, b])
            spans = []
            for r, text in enumerate(texts.to_pylist()):
                text = text or ""
                own = base_spans(text)
                if r in added:
                    raw = text.encode()
                    extra = []
                    for a, b in added[r]:
                        found = raw[a:b].decode("utf-8", "ignore")
                        core = found.strip("+/_.=-")
                        if not core:
                            continue
                        a = len(raw[:a].decode("utf-8", "ignore")) + found.index(core)
                        extra += [(x, y, 3) for x, y in _outside(text, a, a + len(core), own)]
                    own = sorted(own + extra, key=lambda s: (s[0], s[2]))
                spans.append([{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in own])
            yield pa.record_batch(
                [*(batch.column(c) for c in batch.schema.names), pa.array(spans, _SPANS)],
                names=[*batch.schema.names, "secret_spans"],
            )

    return step


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
_SPANS_SQL = "array<struct<start: bigint, end: bigint, kind: string>>"


def scan(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id and `secret_spans`, base spans and those that the field adds.

    Spans are in code points, the end exclusive, in order of start, then kind. An added span
    never overlaps a base span. A null or empty text has no spans; repeated rows have equal ones.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(field)
    steps = [_scanning(sent, id_column, text_column), _without(text_column)]
    return fused(docs, [id_column, text_column], steps, f"`{id_column}` {kind}, secret_spans {_SPANS_SQL}")


def _without(column: str):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            names = [c for c in batch.schema.names if c != column]
            yield batch.select(names)

    return step


def _redacting(text_column: str, mark: str):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for text, spans in zip(
                batch.column(text_column).to_pylist(), batch.column("secret_spans").to_pylist(), strict=True
            ):
                if spans:
                    kept, end = [], 0
                    for span in spans:
                        if span["start"] >= end:
                            kept.append(text[end : span["start"]])
                            kept.append(mark)
                        end = max(end, span["end"])
                    text = "".join(kept) + text[end:]
                out.append(text)
            names = [c for c in batch.schema.names if c != "secret_spans"]
            columns = [pa.array(out, pa.string()) if c == text_column else batch.column(c) for c in names]
            yield pa.record_batch(columns, names=names)

    return step


def redact(
    docs: DataFrame, field: Field, mark: str = "[secret]", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The same rows and columns; every span of `scan` is replaced by the mark, null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    steps = [_scanning(sent, id_column, text_column), _redacting(text_column, mark)]
    return same_rows(docs, steps)


def _digest(id_column: str):
    def joined(spans: list[dict]) -> str:
        return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)

    def step(batches: Batches) -> Batches:
        for batch in batches:
            rows = batch.column("secret_spans").to_pylist()
            base = [[s for s in spans if s["kind"] != KINDS[3]] for spans in rows]
            counts = [
                pa.array([sum(s["kind"] == kind for s in spans) for spans in base], pa.int64())
                for kind in KINDS[:3]
            ]
            digest = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
            yield pa.record_batch(
                [batch.column(id_column), *counts, pa.array(digest), pa.array([joined(s) for s in rows])],
                names=[id_column, "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return step


def digests(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and digest of the base spans of `scan`, and all its spans as text, in one pass."""
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(field)
    schema = f"`{id_column}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return fused(
        docs, [id_column, text_column], [_scanning(sent, id_column, text_column), _digest(id_column)], schema
    )
