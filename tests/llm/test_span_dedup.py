"""Repeated sentence spans against a plain dictionary of spans."""

import random
import re

from tidemark.llm.dedup_queries import op8_sentence_spans
from tidemark.llm.span_dedup import span_dedup, units_of_bytes


def sentences(text, long_words=30):
    """(begin, words) of each sentence, by a plain scan of the words."""
    out, own, begin = [], [], None
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
    for i, m in enumerate(found):
        begin = m.start() if begin is None else begin
        own.append(re.sub("[A-Z]", lambda x: x[0].lower(), m[0]))
        bare = m[0][:-1] if len(m[0]) > 1 and m[0][-1] in "\"')]}" else m[0]
        stop = bare[-1] in ".!?" or i + 1 == len(found) or "\n" in text[m.end():found[i + 1].start()]
        if not stop and len(own) >= long_words and m[0][-1] in ",;":
            stop = True
        if stop:
            out.append((begin, own))
            own, begin = [], None
    return out


def brute_force(rows, min_sentences=2, min_words=25, sentences=sentences):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, gone = set(), {i: set() for i in order}
    for i in order:
        own = sentences(rows[i][1])
        for k in range(len(own)):
            after, n = k, 0
            while after < len(own) and (after - k < min_sentences or n < min_words):
                n += len(own[after][1])
                after += 1
            if after - k < min_sentences or n < min_words:
                continue
            span = tuple(w for _, ws in own[k:after] for w in ws)
            if span in seen:
                gone[i].update(range(k, after))
            seen.add(span)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        own = sentences(text)
        begin = [0, *(b for b, _ in own[1:]), len(text or "")] if own else []
        kept = text if not gone[i] else "".join(
            text[begin[k]:begin[k + 1]] for k in range(len(own)) if k not in gone[i])
        out.append((doc_id, kept, len(own), len(gone[i])))
    return sorted(out, key=str)


def test_same_as_plain_dictionary(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("aé") + str(rng.randrange(5000))
    line = lambda n: " ".join(word() for _ in range(n)) + rng.choice([". ", "! ", ".\n", "\n", '." ', "?) "])
    passages = ["".join(line(rng.randrange(3, 30)) for _ in range(5)) for _ in range(6)]
    rows = []
    for i in range(200):
        parts = [line(rng.randrange(1, 40)) for _ in range(rng.randrange(0, 8))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([p, p.upper(), p.replace(" ", "  ")]))
        rows.append((i, " \t" * (i % 3 == 0) + "".join(parts)))
    rows += [(None, passages[0]), (500, None), (501, ""), (502, "  "), (503, "x. " * 400), (3, rows[3][1]),
             (504, ", ".join(word() for _ in range(500))), (505, "w " * 3000 + passages[1])]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, k int, row int").coalesce(1)
    got = span_dedup(docs).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_sentences"], r["n_removed"]) for r in got), key=str) == brute_force(rows)
    texts = dict(rows[:200])
    for r in got:
        if r["doc_id"] is not None and 3 < r["doc_id"] < 200:
            left = texts[r["doc_id"]]
            for a, b in reversed(r["removed"]):
                left = left[:a] + left[b:]
            assert left == r["text"]


def test_empty_table(spark):
    assert span_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_repeated_run_of_fifty_words_is_met(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: rng.choice("aéж") + str(rng.randrange(10**6))
    words = lambda n: [word() for _ in range(n)]
    marked = lambda n: [w + rng.choice(["", "", "", "", "", "", ".", ",", "?"]) for w in words(n)]
    runs = [rng.choice([words, marked])(rng.randrange(50, 90)) for _ in range(150)]
    rows, at = [], []
    for i, run in enumerate(runs + runs):
        before, behind = words(rng.randrange(0, 30)), marked(rng.randrange(0, 30))
        blank = rng.choice([" ", "\n"])
        rows.append((i, blank.join(before + run + behind)))
        at.append(len(blank.join([*before, ""])))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op8_sentence_spans(spark, str(tmp_path)).collect()}
    for i, (doc_id, text) in enumerate(rows):
        left, removed = got[doc_id]["text"], got[doc_id]["removed"]
        if i < len(runs):
            assert left == text
            continue
        run = re.split(r"\s", text[at[i]:])[:len(runs[i - len(runs)])]
        end = at[i] + len(" ".join(run))
        assert removed and all(at[i] <= a < b <= end + 1 for a, b in removed)
        assert sum(len(text[a:b].split()) for a, b in removed) >= 25


def windowed_sentences(text, width=9):
    """(begin, words) of each piece of a text, word by word: cut at stops and at the least hash of each window."""
    text = text or ""
    found = [m for m in re.finditer(r"[\u3001-\u9fff]|[^\x20\x09-\x0D\u3001-\u9fff]+", text)]
    plain = [re.sub("[A-Z]", lambda x: x[0].lower(), m[0]) for m in found]
    hashes = [int(units_of_bytes(w.encode())[2][0]) for w in plain]
    stop = []
    for m in found:
        bare = m[0][:-1] if len(m[0]) > 1 and m[0][-1] in "\"')]}" else m[0]
        stop.append(bare[-1] in ".!?。")
    cut = stop.copy()
    for i in range(len(found) - width + 1):
        if not any(stop[i:i + width]):
            least = min(hashes[i:i + width])
            cut[max(j for j in range(i, i + width) if hashes[j] == least)] = True
    if cut:
        cut[-1] = True
    out, k = [], 0
    for i, last in enumerate(cut):
        if last:
            out.append((found[k].start(), plain[k:i + 1]))
            k = i + 1
    return out


def test_registered_parameters_against_a_plain_dictionary(spark, tmp_path, monkeypatch):
    rng = random.Random(11)
    vocabulary = ["a" + str(k) for k in range(900)] + ["É" + str(k) for k in range(90)] + ["The", "of", "of"] * 9
    words = lambda n: [rng.choice(vocabulary) + rng.choice(["", "", "", "", "", ".", "!", ",", '."']) for _ in range(n)]
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(400)) + ("。" if rng.random() < 0.05 else "") for _ in range(n))
    passages = [" ".join(words(rng.randrange(20, 90))) for _ in range(8)] + [han(rng.randrange(30, 90)) for _ in range(4)]
    rows = []
    for i in range(160):
        parts = [" ".join(words(rng.randrange(0, 60))) for _ in range(3)] + [han(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        rows.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "of " * 400), (204, "of " * 300), (None, passages[0]), (7, rows[7][1])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute_force(rows, sentences=windowed_sentences)
    for bits in (27, 6):  # with room, and with a filter that lets everything pass
        monkeypatch.setattr("tidemark.llm.span_dedup.FILTER_BITS", bits)
        got = op8_sentence_spans(spark, str(tmp_path)).collect()
        assert sorted(((r["doc_id"], r["text"], r["n_sentences"], r["n_removed"]) for r in got), key=str) == want
    assert sum(r[3] for r in want) > 100
