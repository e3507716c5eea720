"""Plain versions of what the operators find, for small fixtures."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def find(links, nodes):
    root = {n: n for n in nodes}

    def up(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return {n: up(n) for n in nodes}


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}


def near(docs):
    """{doc_id: (set size, component)} of {doc_id: text}."""
    sets = {k: shingles(t) for k, t in docs.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    owner = find(links, list(sets))
    return {k: (len(sets[k]), owner[k]) for k in sets}


def lines(docs, min_docs=5):
    """{doc_id: (lines, dropped, kept text)} of {doc_id: text}."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for k, t in docs.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(k)
    out = {}
    for k, t in docs.items():
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(holders.get(key(x), ())) < min_docs or k == max(holders[key(x)])]
        out[k] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out
