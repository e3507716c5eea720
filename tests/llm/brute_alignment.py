"""A plain version of the alignment: whole texts, straight from the tokenizers."""

import hashlib
from collections import Counter

import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer, decoders


def streams(texts):
    """Per text the (id, bytes) lists of both tokenizers for a space and the text, or None."""
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(x): x for x in plain}
    table.update({chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)})
    assert decoders.ByteLevel().decode(["Ġx"]) == " x"

    def piece(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()

    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        one = [(k, bytes(table[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(k, piece(k)) for k in b.encode(text)]
        want = (" " + text).encode()
        same = b"".join(x for _, x in one) == want == b"".join(x for _, x in two)
        out.append((one, two) if same else None)
    return out


def aligned(texts):
    """The contract's columns behind doc_id, per text."""
    groups, links = [], []
    for found in streams(texts):
        groups.append([])
        links.append([])
        if not found:
            continue
        i = j = p = q = x = y = 0
        one, two = found
        while i < len(one):
            x += len(one[i][1])
            i += 1
            while y < x:
                y += len(two[j][1])
                j += 1
            if x == y:
                groups[-1].append((one[p:i], two[q:j]))
                links[-1].append((one[i - 1][0], two[j - 1][0]))
                p, q = i, j
    count = Counter(x for row in links for x in row)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for g, row in zip(groups, links, strict=True):
        text = ";".join(f"{','.join(str(k) for k, _ in a)}|{','.join(str(k) for k, _ in b)}" for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(row), sum(count[x] == best[x[1]] for x in row),
                    sum(count[x] for x in row), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out
