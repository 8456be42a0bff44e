"""Brute-force cross-tokenizer alignment, for the tests: byte offsets walked one token at a time."""

import hashlib
from collections import Counter

import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer


def tokens(texts):
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    decoder = {}
    printable = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    k = 0
    for x in range(256):
        if x in printable:
            decoder[chr(x)] = x
        else:
            decoder[chr(256 + k)] = x
            k += 1
    inv_a = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}

    def a_bytes(i):
        return bytes(decoder[c] for c in inv_a[i])

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba, bb = [a_bytes(i) for i in ia], [b_bytes(i) for i in ib]
        want = (" " + t).encode()
        out.append((ia, ib, ba, bb) if b"".join(ba) == want and b"".join(bb) == want else None)
    return out


def alignment(rows):
    per_doc, links_all = [], Counter()
    for (doc_id, _), tok in zip(rows, tokens([t for _, t in rows])):
        if tok is None:
            per_doc.append((doc_id, 0, 0, 0, 0, "", []))
            continue
        ia, ib, ba, bb = tok
        groups, links, cur_a, cur_b = [], [], [], []
        i = j = ea = eb = 0
        while i < len(ia) or j < len(ib):
            if j >= len(ib) or (i < len(ia) and ea + len(ba[i]) <= eb + len(bb[j])):
                ea += len(ba[i]); cur_a.append(ia[i]); i += 1
            else:
                eb += len(bb[j]); cur_b.append(ib[j]); j += 1
            if ea == eb and cur_a and cur_b:
                groups.append(",".join(map(str, cur_a)) + "|" + ",".join(map(str, cur_b)))
                links.append((cur_a[-1], cur_b[-1]))
                cur_a, cur_b = [], []
        links_all.update(links)
        per_doc.append((doc_id, len(ia), len(ib), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    best = {}
    for (a, b), c in links_all.items():
        best[b] = max(best.get(b, 0), c)
    return {
        d[0]: (d[1], d[2], d[3], d[4], sum(links_all[l] == best[l[1]] for l in d[6]), sum(links_all[l] for l in d[6]), d[5])
        for d in per_doc
    }
