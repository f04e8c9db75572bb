"""Brute-force versions: plain Python over plain rows."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text, width=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """Smallest member of each member's component, by depth-first search over all pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(rows):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    rows = sorted(rows, key=lambda r: r[0])
    marks = [fingerprint(t) for _, t in rows]
    roots = groups(len(rows), lambda i, j: (marks[i] ^ marks[j]).bit_count() <= 3)
    return sorted((rows[i][0], f"{marks[i]:016x}", rows[roots[i]][0]) for i in range(len(rows)))


def line_dedup(rows, min_chars=10, min_docs=2):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(keep), sha("\n".join(keep))))
    return sorted(out)


def spans_of(words, size):
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    wins = spans_of(words, 8)
    covered = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def substring_dedup(rows, size=20):
    seen, out = set(), []
    for i, t in sorted(rows):
        words = WORD.findall(t or "")
        gone = set()
        for at, w in enumerate(spans_of(words, size)):
            if w in seen:
                gone |= set(range(at, at + size))
            seen.add(w)
        out.append((i, len(words), len(gone), sha(" ".join(w for j, w in enumerate(words) if j not in gone))))
    return out


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, size=13):
    wins = {}
    for name, t in items:
        words = BENCH_WORD.findall((t or "").translate(LOWER))
        for w in (spans_of(words, min(size, len(words))) if words else []):
            wins.setdefault(w, set()).add(str(name))
    out = []
    for i, t in rows:
        words = BENCH_WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in wins}:
            for at, w in enumerate(spans_of(words, n)):
                if w in wins:
                    hit |= set(range(at, at + n))
                    found |= wins[w]
        out.append((i, len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=lambda r: r[0])
