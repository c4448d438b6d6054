"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

LOWER = {c: c + 32 for c in range(65, 91)}
SPACES = re.compile("[\x20\x09-\x0d]+")
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def spaced(text, lower=True):
    text = text or ""
    return [w for w in SPACES.split(text.translate(LOWER) if lower else text) if w]


def components(docs, size=5, percent=80):
    """Sorted (doc_id, n_shingles, component_id)."""
    sets = []
    for _, text in docs:
        w = spaced(text)
        many = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
        sets.append(many or ({tuple(w)} if w else set()))
    holders = collections.defaultdict(list)
    for k, own in enumerate(sets):
        for g in own:
            holders[g].append(k)
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, own in enumerate(sets):
        shared = collections.Counter(m for g in own for m in holders[g] if m < k)
        for m, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[m]) - n):
                parent[find(k)] = find(m)
    least = {}
    for k, (key, _) in enumerate(docs):
        if key is not None:
            least[find(k)] = min(least.get(find(k), key), key)
    return sorted(
        ((key, len(sets[k]), least.get(find(k)) if sets[k] else key) for k, (key, _) in enumerate(docs)), key=repr
    )


def contamination(docs, benchmark, window=13):
    """Sorted (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = collections.defaultdict(set)
    for item, text in benchmark:
        w = WORDS.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[n, tuple(w[k : k + n])].add(item)
    lengths = {n for n, _ in windows}
    out = []
    for key, text in docs:
        w = WORDS.findall((text or "").translate(LOWER))
        hit, items = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                found = windows.get((n, tuple(w[k : k + n])))
                if found:
                    hit.update(range(k, k + n))
                    items |= found
        names = sorted(str(x) for x in items if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def rule_counts(text):
    text = text or ""
    w = spaced(text, lower=False)
    windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    repeat = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if spaced(line):
            doubled += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), doubled, len(repeat)


def removed(docs, length=100):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, kept_sha256); ids are distinct."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            own = raw[k : k + length]
            if own in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(own)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_scores(docs):
    """Sorted (doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    held = [key is not None and zlib.crc32(str(key).encode()) % 5 == 1 for key, _ in docs]
    tokens = [[*spaced(text), None] for _, text in docs]
    c = collections.Counter(t for own, h in zip(tokens, held, strict=True) if not h for t in own)
    n, v = sum(c.values()), len(c)
    return sorted(
        (
            (key, h, len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own))
            for (key, _), h, own in zip(docs, held, tokens, strict=True)
        ),
        key=repr,
    )


def base_spans(text):
    """(start, end, kind) by the patterns as they are stated."""
    text = text or ""
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), m.end(), 0) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], s[2]))
