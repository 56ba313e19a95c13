"""Small corpora with planted cases, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 1, n: int = 60):
    """(doc_id, text, lang, source, n_chars): prose, copies, near copies, shared passages, junk, nulls and empties."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(k):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "  "]) for _ in range(k))

    passage = prose(110)
    texts = [prose(rng.choice([1, 3, 6, 30, 80, 200])) for _ in range(n)]
    texts += texts[:6] + [texts[0]] * 5
    for t in texts[10:20]:
        parts = t.split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += [prose(20) + passage + prose(30) for _ in range(4)]
    texts += [None, None, "", " \n\t ", "x", "a" * 1000, "ab" * 900, "one two three four", "ONE two  three\nfour", "# | " * 50]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None]), None) for i, t in enumerate(texts)]


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard_components(docs):
    sets = {d[0]: shingle_set(d[1]) for d in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = least_reachable(sets, links)
    return {i: (len(sets[i]), least[i]) for i in sets}


def cut_repeats(docs, length):
    places = defaultdict(list)
    for i, text, *_ in docs:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            places[data[k: k + length]].append((i, k))
    gone = defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for i, k in found:
                gone[i] |= set(range(k, k + length))
    out = {}
    for i, text, *_ in docs:
        data = (text or "").encode()
        rest = bytes(b for k, b in enumerate(data) if k not in gone[i])
        spans = sum(k - 1 not in gone[i] for k in gone[i])
        out[i] = (len(data), len(gone[i]), spans, hashlib.sha256(rest).hexdigest())
    return out


def base_signals(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i: i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i: i + 8])] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def character_set(line):
    return {line[i: i + 5] for i in range(max(1, len(line) - 4))}


def line_components(docs):
    lines = {}
    for i, text, *_ in docs:
        for k, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                lines[(i, k)] = line
    sets = {p: character_set(x) for p, x in lines.items()}
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    return least_reachable(sets, [(a, b) for a in sets for b in sets if a < b and near(a, b)])
