"""Plain single-process versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def packed(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def bpe(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(packed(ids)), sha(tokenizer.decode(ids, skip_special_tokens=False))


def token_files(tokenizer, rows):
    out, start = {}, 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out[doc_id] = (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    def holds(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in KINDS for m in re.finditer(p, text or "") if holds(k, m[0])]


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def repeats(rows, window):
    words = [(doc_id, WORD.findall(text or "")) for doc_id, text in rows]
    count = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), kept))
    return out


def shingles(text, size):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(lower)
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def near(rows, size=2, percent=80):
    """doc_id: (set size, smallest id of the component); ids are distinct."""
    sets = {k: shingles(t, size) for k, t in rows}
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k: (len(sets[k]), top(k)) for k in ids}


def edited(rows):
    rows = sorted(rows)
    out = {}
    for i, (k, text) in enumerate(rows):
        following, cut = rows[(i + 1) % len(rows)][1] or "", len(text or "") // 4
        out[k] = (len(text or ""), sha((text or "")[: len(text or "") - cut] + following[:cut]))
    return out


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def chat(turns):
    said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
    loss = "".join(text or "" for _, role, text in turns if role == "assistant")
    return len(turns), sha(said), len(loss), sha(loss)


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def url(value):
    host = path = ""
    if value and "://" in value:
        rest = value.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate({c: c + 32 for c in range(65, 91)})
    fitting = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fitting, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def shared_lines(rows, least_chars=20, least_docs=3):
    """doc_id, number of lines, number dropped, the rest; every row is a document."""
    def key(line):
        k = line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate({c: c + 32 for c in range(65, 91)})
        return k if len(k) >= least_chars else None

    order = lambda doc_id: (doc_id is not None, doc_id or 0)
    count, last, out = Counter(), {}, []
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            count[k] += 1
            last[k] = max(last.get(k, (False, 0)), order(doc_id))
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [(k := key(x)) is not None and count[k] >= least_docs and last[k] != order(doc_id) for x in lines]
        out.append((doc_id, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def runs(words):
    """(start, length, period) of all runs, and the words without their repeated parts."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
    out = sorted((s, e - s, q) for (s, e), q in found.items())
    gone = {i for s, length, q in out for i in range(s + q, s + length)}
    return out, " ".join(w for i, w in enumerate(words) if i not in gone)


def damaged(rows):
    """(conv_id, turn, role, text) with the faults planted by a checksum."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, edits, rows left) by trying all edits of (role, text, fault)."""
    best = {("", 0): (0, "", ())}  # by state of the grammar and rows read

    def allowed(state, initial):
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[state]

    states = ("", "s", "u", "a")
    for i in range(len(rows) + 1):
        for _ in range(3):
            for state in states:
                if (state, i) in best:
                    cost, audit, left = best[state, i]
                    role = "assistant" if state == "u" else "user"
                    new = (cost + 5, audit + "I", (*left, (role, "")))
                    key = (role[0], i)
                    best[key] = min(best.get(key, new), new)
        if i == len(rows):
            break
        role, text, fault = rows[i]
        for state in states:
            if (state, i) not in best:
                continue
            cost, audit, left = best[state, i]
            options = [(state, cost + 2, "D", left)]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault else 0
                if role and allowed(state, role[0]):
                    options.append((role[0], cost + extra, "K", (*left, (role, text))))
                to = "assistant" if state == "u" else "user"
                options.append((to[0], cost + extra + 1, "R", (*left, (to, text))))
            for to, c, e, rest in options:
                new, key = (c, audit + e, rest), (to, i + 1)
                best[key] = min(best.get(key, new), new)
    return min(best[s, len(rows)] for s in ("", "a") if (s, len(rows)) in best)


def repair(rows):
    """What op11 returns of one conversation's (turn, role, text) after damage, but for its id."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    rows, seen, read = sorted(rows, key=order), set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        read.append((role, text, fault))
    turns = {t for t, _, _ in rows} - {None}
    count = Counter(f for _, _, f in read)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(read, read[1:])]
    cost, audit, left = cheapest(read)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(count[f] for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, sha("\n".join(f"{r}:{t}" for r, t in left)),
    )
