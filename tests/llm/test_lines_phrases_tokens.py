"""Line deduplication, collocations and token alignment against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from seawake.llm import alignment, collocations, lines
from seawake.llm.bpe import byte_letters
from seawake.llm.cuckoo import Cuckoo
from seawake.llm.lines import LineIndex, line_digests, without_repeated_lines

LOWER = {c: c + 32 for c in range(65, 91)}

# --- lines --------------------------------------------------------------------


def line_key(line):
    key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    return key if len(key) >= 10 else None


def line_rows(held, docs):
    """held, docs: (id, text); {id: (lines, dropped, sha256)} of docs."""
    owners = defaultdict(set)
    for i, text in held:
        for line in (text or "").split("\n"):
            owners[line_key(line)].add(i)
    out = {}
    for i, text in docs:
        every = (text or "").split("\n")
        keys = [(x, line_key(x)) for x in every]
        kept = [x for x, k in keys if k is None or len(owners[k]) < 2 or i not in owners[k] or i == min(owners[k])]
        out[i] = (len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def random_pages(n, seed):
    rng = random.Random(seed)
    common = ["Terms And Conditions", " privacy notice\t", "PRIVACY NOTICE", "éééééééééé", "ééééééééé", "short", "", "İstanbul footer", "x" * 200]
    pages = []
    for i in range(n):
        own = [rng.choice(common) if rng.random() < 0.6 else f"line {rng.randrange(9999999)} of {i}" for _ in range(rng.randrange(0, 12))]
        pages.append((i, "\n".join(own)))
    return pages


def found(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in df.collect()}


def test_filters_hold_forget_and_report_being_full():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    held = Cuckoo.sized(len(keys))
    assert held.insert(keys) and held.contains(keys).all()
    others = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert held.contains(others).mean() < 0.001
    held.remove(keys[:15_000])
    held = Cuckoo.from_bytes(held.to_bytes())
    assert held.contains(keys[15_000:]).all() and held.held == 5000
    assert held.insert(keys[:2].repeat(3)) and held.contains(keys[:2]).all()
    held.remove(keys[:2].repeat(3))
    with pytest.raises(ValueError):
        held.remove(others[~held.contains(others)][:1])
    small = Cuckoo.sized(10)
    assert not small.has_room(100) and not small.insert(keys[:100])


def test_inserting_and_deleting_equals_the_documents_left(spark):
    pages = random_pages(160, 5) + [(900, None), (901, ""), (902, "\n\n")]
    df = spark.createDataFrame(pages, "doc_id long, text string")
    index = LineIndex.empty(spark)
    for low in (0, 60):
        index = index.insert(df.filter(f"doc_id % 120 >= {low} AND doc_id % 120 < {low + 60}"))
    assert found(line_digests(df, index)) == line_rows(pages, pages)
    # the smallest holders of the common lines go, some ids are not held, then some come back with another text
    index = index.delete(spark.createDataFrame([(i,) for i in [*range(0, 30), 77, 5000]], "doc_id long"))
    held = [p for p in pages if not (p[0] < 30 or p[0] == 77)]
    assert found(line_digests(df, index)) == line_rows(held, held) | line_rows([], [p for p in pages if p not in held])
    again = [(3, "terms and conditions\nnew line of three"), (77, "privacy notice"), (100, "held already: no effect")]
    index = index.insert(spark.createDataFrame(again, "doc_id long, text string"))
    held = sorted(held + again[:2])
    assert found(line_digests(spark.createDataFrame(held, "doc_id long, text string"), index)) == line_rows(held, held)
    counts = {bytes(r["key"]): (r["documents"], r["first"]) for r in index.current().filter("documents > 0").collect()}
    owners = defaultdict(set)
    for i, text in held:
        for key in {lines.line_key(x.encode()) for x in (text or "").split("\n")} - {None}:
            owners[key].add(i)
    assert counts == {k: (len(v), min(v)) for k, v in owners.items()}
    # the filters hold the keys of the counts and no others
    entries = sum(Cuckoo.from_bytes(r["filter"]).held for r in index.filters.collect())
    assert entries == len(counts)
    assert index._probed(index.current().filter("documents > 0")).filter("NOT known").isEmpty()


def test_many_shards_saved_and_loaded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lines, "SHARD_KEYS", 20)
    pages = random_pages(200, 8)
    df = spark.createDataFrame(pages, "doc_id long, text string")
    index = lines.deduplicated(df, increments=3)
    assert index.shards > 5
    index.save(str(tmp_path / "index"))
    index = LineIndex.load(spark, str(tmp_path / "index"))
    assert found(line_digests(df, index)) == line_rows(pages, pages)
    index = index.delete(df.filter("doc_id < 40"))
    assert found(line_digests(df.filter("doc_id >= 40"), index)) == line_rows(pages[40:], pages[40:])


def test_odd_lines_and_columns(spark):
    rows = [(2, "Same footer line\na", "x"), (None, " same FOOTER line\r\nb", "y"), (2, "Same footer line", None), (1, "Same footer linE\x0b\nSame footer line", "z")]
    df = spark.createDataFrame([(*r, "t", b"k") for r in rows], "doc_id long, text string, `row` string, doc string, keys binary")
    index = lines.deduplicated(df)
    out = {(r["doc_id"], r["row"]): r["text"] for r in without_repeated_lines(df, index).collect()}
    assert out == {(2, "x"): "a", (None, "y"): "b", (2, None): "", (1, "z"): rows[3][1]}
    assert without_repeated_lines(df, index).columns == df.columns
    empty = df.filter("doc_id > 99")
    assert line_digests(empty, lines.deduplicated(empty)).count() == 0
    long = spark.createDataFrame([(1, "long line of text\n" * 200_000), (2, "long line of text")], "doc_id long, text string")
    assert found(line_digests(long, lines.deduplicated(long)))[2][1] == 1


# --- collocations -------------------------------------------------------------


def phrase_rows(docs, top, least):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        rows = []
        for p, a in candidates.items():
            if longer[p] < a:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def random_prose(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 4))) for _ in range(40)]
    fixed = ["new york city hall", "a a a a a a", "in spite of\tall that", "ab AB Ab"]
    docs = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(0, 60))]
        text = "".join(p + rng.choice([" ", " ", "  ", ", ", "\n", ".", "\x0b", "\x85", "\xa0"]) for p in parts)
        docs.append((rng.choice(["en", "fr", None]), text))
    return docs + [("en", None), ("de", ""), ("fr", "...")]


@pytest.mark.parametrize("slots", [None, 1 << 16])
def test_phrases_are_those_of_plain_counting(spark, monkeypatch, slots):
    if slots:  # small tasks, and long texts cut in parts
        monkeypatch.setattr(collocations, "MAX_SLOTS", slots)
    docs = random_prose(250, 2)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, n int, words string").repartition(3)
    for top, least in ((2000, 20), (7, 3)):
        assert sorted(map(tuple, collocations.collocations(df, top, least).collect())) == phrase_rows(docs, top, least)


def test_phrases_of_long_texts_and_none(spark):
    text = ("the old man and the sea, " * 20 + "word ") * 12_000
    assert len(collocations._cut(text.encode())) > 1 and b"".join(collocations._cut(text.encode())) == text.encode()
    docs = [("en", text), ("en", "unlike words")]
    df = spark.createDataFrame(docs, "lang string, text string")
    rows = {r["phrase"]: r for r in collocations.collocations(df).collect()}
    assert rows["and the sea"]["a"] == 240_000 if "and the sea" in rows else "the old man and the" in rows
    assert rows["old man and the sea"]["a"] == 240_000 and rows["old man and the sea"]["n"] == 1_452_002
    assert collocations.collocations(df.filter("lang = 'x'")).count() == 0


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", ["a"], 3 * 10**12), ("en", ["b"], 2 * 10**12), ("en", ["a", "b"], 10**12)], "lang string, words array<string>, f long"
    )
    totals = spark.createDataFrame([("en", 9 * 10**12)], "lang string, n long")
    candidates = phrases.filter("size(words) = 2").withColumnRenamed("f", "a")
    row = collocations._scored(candidates, phrases, totals).first()
    assert row["score"] == 1000 * 10**12 * 9 * 10**12 // (6 * 10**24) and row["k"] == 1


# --- alignment ----------------------------------------------------------------

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "plain words, and more.", "two  spaces\n\nlines \n x", " leading", "\nnewline first", "trailing ", "tab\tand\r\nreturn ;\r\n", "a▁b ▁ c",
    "<|endoftext|> as text<s></s><unk>", "<0x41>", "日本語 テキスト、です。", "naïve café é", "x" * 300, " ", "\n", "  ", "don't stop-it (now) [1.5e-3]",
    "😀 emoji 😀😀", "\x1c\x1d sep \x85 nel\xa0nbsp  wide　x", "٣٤٥ १२३",
]


def alignment_rows(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    side_a, side_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    side_a.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(byte_letters())}
    own, links = [], Counter()
    for _, text in docs:
        own.append(None)
        if not text:
            continue
        encoded, whole = side_a.encode(" " + text, add_special_tokens=False), (" " + text).encode()
        a, b = encoded.ids, side_b.encode(text)
        bytes_a = [bytes(letters[c] for c in t) for t in encoded.tokens]
        bytes_b = [bytes([int(side_b.id_to_piece(i)[3:5], 16)]) if side_b.is_byte(i) else side_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            continue
        ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b))
        pairs, groups, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[at_a:i])) + "|" + ",".join(map(str, b[at_b:j])))
            pairs.append((a[i - 1], b[j - 1]))
            at_a, at_b = i, j
        links.update(pairs)
        own[-1] = (len(a), len(b), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest())
    most = Counter()
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), row in zip(docs, own, strict=True):
        if row is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, pairs, sha = row
            out.append((i, n_a, n_b, len(pairs), len(pairs), sum(links[p] == most[p[1]] for p in pairs), sum(links[p] for p in pairs), sha))
    return out


@pytest.mark.parametrize("hot", [alignment.HOT_PAIRS, 40, 0])
def test_alignments_are_those_of_whole_texts(spark, hot):
    rng = random.Random(4)
    texts = ODD + [None, ""] + ["".join(rng.choice(["the ", "word", "ing ", "\n", "  ", "é", "▁", "\t", ".", "'s ", "\r", "12 ", "<s>"]) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    docs = [(i // 2, t) for i, t in enumerate(texts)] + [(None, texts[0])]
    df = spark.createDataFrame([(*d, "p", 1) for d in docs], "doc_id long, text string, pairs string, `row` int").repartition(3)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = alignment.alignment(df, A, B, hot_pairs=hot).select(columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(alignment_rows(docs), key=repr)


def test_alignment_of_no_rows_and_of_a_long_text(spark):
    df = spark.createDataFrame([(1, "word and word\n" * 20_000)], "doc_id long, text string")
    assert alignment.alignment(df.filter("doc_id = 2"), A, B).count() == 0
    row = alignment.alignment(df, A, B).first()
    assert row["n_links"] == row["n_groups"] == 80_000 and row["n_best"] == 80_000


def test_overlaps_are_all_pairs_with_a_common_byte():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sides, total = [], rng.integers(1, 30, 4)
        for _ in range(2):
            rows, base = [], 0
            for text, size in enumerate(total):
                cuts = np.unique(np.r_[0, rng.integers(0, size, 6)])
                rows += [(text, base + s, base + e) for s, e in zip(cuts, [*cuts[1:], size], strict=True)]
                base += size
            sides.append(pd.DataFrame(rows, columns=["text", "start", "end"]))
        a, b = sides
        want = {(i, j) for i, x in enumerate(a.itertuples()) for j, y in enumerate(b.itertuples()) if x.start < y.end and y.start < x.end}
        assert set(map(tuple, alignment.overlaps(a, b).to_numpy().tolist())) == want
