"""Plain versions of periodic runs and their digests."""

import hashlib
import zlib

from .brute import WORD


def runs(words):
    """(start, length, period) of every run, by trying all periods."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i:i + length]
            if j > i and length >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    """The contract's row of one document."""
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, k, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    return (len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())
