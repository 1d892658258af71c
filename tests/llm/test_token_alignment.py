"""Token alignment against whole-text encoding and plain loops over byte ranges."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import tidemark.llm.token_alignment as operator
from tidemark.llm.output_queries import op11_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens():
    """Functions that give [(id, bytes)] of a text for each tokenizer."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    keep = set(range(ord("!"), ord("~") + 1)) | set(range(ord("¡"), ord("¬") + 1)) | set(range(ord("®"), ord("ÿ") + 1))
    to_byte, extra = {}, 0
    for byte in range(256):
        to_byte[chr(byte) if byte in keep else chr(256 + extra)] = byte
        extra += byte not in keep
    names = {k: t for t, k in a.get_vocab().items()}

    def of_a(text):
        return [(k, bytes(to_byte[c] for c in names[k])) for k in a.encode(" " + text, add_special_tokens=False).ids]

    def of_b(text):
        out = []
        for k in b.encode(text):
            piece = b.id_to_piece(k)
            byte = len(piece) == 6 and piece.startswith("<0x")
            out.append((k, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
        return out
    return of_a, of_b


def ranges(tokens):
    at, out = 0, []
    for k, raw in tokens:
        out.append((k, at, at + len(raw)))
        at += len(raw)
    return out


def brute_force(texts):
    of_a, of_b = plain_tokens()
    each, counts = [], Counter()
    for text in texts:
        a, b = (of_a(text), of_b(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(x for _, x in own) != raw for own in (a, b)):
            each.append(None)
            continue
        a, b = ranges(a), ranges(b)
        links = []
        low = 0
        for i, x, y in a:
            while b[low][2] <= x:
                low += 1
            k = low
            while k < len(b) and b[k][1] < y:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({y for _, _, y in a} & {y for _, _, y in b})
        groups = [([], []) for _ in cuts]
        for side, own in enumerate((a, b)):
            g = 0
            for i, _, y in own:
                while cuts[g] < y:
                    g += 1
                groups[g][side].append(str(i))
        written = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        each.append((len(a), len(b), len(cuts), links, hashlib.sha256(written.encode()).hexdigest()))
        counts.update(set(links))
    best = Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if e is None else
            (*e[:3], len(e[3]), sum(counts[p] == best[p[0]] for p in e[3]), sum(counts[p] for p in e[3]), e[4]) for e in each]


def odd_texts():
    rng = random.Random(1)
    pieces = ["alpha", "naïve", " ", "  ", "\n", "\n\n", "\t", "\r\n", "don't", "<|endoftext|>", "<s>", "<0x41>", "名前", "😀", " ",
              " ", "\x1c", "x" * 30, "aaaa", "!!", " a", "Ω", "end.", "\x00", "１２", "ﬁ", "é", "12345", "​", "{\r", "=>\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(150)]
    return [None, "", " ", "\n", "   ", "a", " a", "a ", "a\n", "▁", "a▁b", "plain words here", "plain words here", "aaaaaaa aaaa aaaaaaaaa",
            "tab\tand\x0bother\x0cspaces", "long " * 30_000, "y" * 20_000, *texts]


@pytest.mark.parametrize("known, cached, together", [(1 << 18, 500_000, 256), (3, 20, 2)])
def test_same_as_plain_loops(spark, monkeypatch, known, cached, together):
    monkeypatch.setattr(operator, "CACHED_CHUNKS", cached)
    monkeypatch.setattr(operator, "TOGETHER", together)
    texts = odd_texts()
    rows = [(None if k == 11 else k // 2, t, "x", 1) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string, code int")
    got = operator.align_tokens(frame.repartition(4), A, B, known_pairs=known)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = sorted(((r[0], *w) for r, w in zip(rows, brute_force(texts), strict=True)), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_chunks_are_exact():
    aligner = operator.Aligner(A, B)
    assert aligner.tokens.local
    texts = [t for t in odd_texts() if t]
    for text, found in zip(texts, aligner(texts), strict=True):
        whole = aligner._whole(text)
        assert (found is None) == (whole is None)
        if whole:
            assert tuple(found[0]) == tuple(whole[0]) and found[1] == whole[1] and (found[2] == whole[2]).all()


def test_whole_texts_if_tokens_reach_over_cuts():
    aligner, texts = operator.Aligner(A, B), [t for t in odd_texts() if t]
    chunked = aligner(texts)
    aligner.tokens.local = False
    for one, other in zip(chunked, aligner(texts), strict=True):
        assert (one is None) == (other is None)
        assert one is None or (one[1] == other[1] and (one[2] == other[2]).all())


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r["doc_id"], *w) for r, w in zip(docs, brute_force([r["text"] for r in docs]), strict=True))
    assert sorted(map(tuple, op11_token_alignment(spark, sf).collect())) == want


def test_empty_table(spark):
    assert operator.align_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
