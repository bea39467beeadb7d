"""Alignment, periodic runs and SimHash against brute force and awkward inputs."""

import hashlib
import random
import zlib
from fractions import Fraction
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from storyspark.llm import alignment, decontaminate, queries, runs, simhash

DIR = "/root/testdata/sf0.001"
LEFT, RIGHT = public_tokenizers.path(queries.LEFT), public_tokenizers.path(queries.RIGHT)
DOCS = "doc_id long, text string, lang string, source string, row long, pairs string, print string, start int"
TEXTS = [None, "", " \n\t ", "a", "a b", "a a a a a a", "x y " * 40, "é" * 50, "▁ literal piece", "\x00 nul 😀 <|endoftext|> <s> end",
         "word " * 3000, "一二三四五六七八九十" * 30, "tie tie", "one two three four", "one two three four", "ZZ zz " * 9]


def table(spark, texts):
    rows = [(k, t, None, "s", 1, "p", "q", 2) for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], (None, "one two three four", "en", None, 1, "x", "y", 0)], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, TEXTS)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]


def stored(df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Operator 11

def plain_alignment(texts):
    """Groups by walking all byte ends; counts by a dict."""
    left, right = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    left.encode_special_tokens = True
    spell = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    for b in range(256):
        if b not in spell:
            spell[b] = chr(256 + sum(k >= 256 for k in map(ord, spell.values())))
    back = {c: b for b, c in spell.items()}
    cut, held = [], {}
    for text in texts:
        text = text or ""
        a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
        x = [bytes(back[c] for c in left.id_to_token(k)) for k in a]
        y = [bytes([int(right.id_to_piece(k)[3:5], 16)]) if right.is_byte(k)
             else right.id_to_piece(k).replace("▁", " ").encode() for k in b]
        whole = (" " + text).encode()
        if not text or b"".join(x) != whole or b"".join(y) != whole:
            cut.append(([], [], []))
            continue
        ends = [[sum(map(len, z[:k + 1])) for k in range(len(z))] for z in (x, y)] if len(x) < 50 else [
            np.cumsum([len(t) for t in z]).tolist() for z in (x, y)]
        common = sorted(set(ends[0]) & set(ends[1]))
        of = [np.searchsorted(common, e).tolist() for e in ends]
        groups = [([], []) for _ in common]
        for side, ids in enumerate((a, b)):
            for k, g in zip(ids, of[side]):
                groups[g][side].append(k)
        cut.append((a, b, groups))
        for pair in {(i, j) for one, two in groups for i in one for j in two}:
            held[pair] = held.get(pair, 0) + 1
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for a, b, groups in cut:
        links = [(i, j) for one, two in groups for i in one for j in two]
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query(spark, documents):
    got = rows_of(queries.op11_token_alignment(spark, DIR).select(*COLUMNS))
    want = plain_alignment([t for _, t in documents])
    assert got == sorted(((k, *w) for (k, _), w in zip(documents, want)), key=repr)


@pytest.mark.parametrize("heavy", [1, 50, alignment.HEAVY])
def test_alignment_awkward(spark, awkward, heavy, monkeypatch):
    monkeypatch.setattr(alignment, "LISTED", 3)
    texts = [*TEXTS, TEXTS[4], "one two three four"]
    aligned = alignment.aligned_digests(awkward, LEFT, RIGHT)
    got = rows_of(alignment.count_links(aligned, alignment.right_ids(RIGHT), heavy).select(*COLUMNS))
    ids = [*range(len(TEXTS)), 4, None]
    assert got == sorted(((k, *w) for k, w in zip(ids, plain_alignment(texts))), key=repr)
    assert {r[1] for r in got if r[0] in (0, 1, 8)} == {0}


def test_alignment_empty(spark):
    aligned = alignment.aligned_digests(spark.createDataFrame([], DOCS), LEFT, RIGHT)
    assert alignment.count_links(aligned, alignment.right_ids(RIGHT)).count() == 0


@pytest.fixture(scope="module")
def both_sides():
    made = [alignment.tokenizer(path, open(path, "rb").read()) for path in (LEFT, RIGHT)]
    whole, pieces = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    whole.encode_special_tokens = True
    return [(made[0], lambda t: whole.encode(" " + t, add_special_tokens=False).ids), (made[1], pieces.encode)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" ab1.\n\t'"), st.characters(codec="ascii"), st.characters(codec="utf-8")),
                        max_size=20), max_size=4))
def test_remembered_words_are_encoded_as_in_whole_texts(both_sides, texts):
    for side, plain in both_sides:
        want = [plain(t) for t in texts]
        for limit in (alignment.REMEMBERED, 0):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(alignment, "REMEMBERED", limit)
                ids, counts = side.encode(texts)
            assert ids.tolist() == [k for row in want for k in row] and counts.tolist() == [len(row) for row in want]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40), st.lists(st.integers(1, 60), max_size=40), st.integers(61, 70))
def test_skip_diagonals(a, b, last):
    a, b = sorted({*a, last}), sorted({*b, last})
    cuts = []
    for i, i2, j, j2, one in alignment.skip_diagonals(a, b):
        assert not one or i2 - i == j2 - j
        cuts.extend(zip(range(i + 1, i2 + 1), range(j + 1, j2 + 1)) if one else [(i2, j2)])
    assert cuts == [(a.index(e) + 1, b.index(e) + 1) for e in sorted(set(a) & set(b))]


def test_group_beyond_the_list_is_counted(monkeypatch):
    a, b = np.array([1, 1, 2, 3, 1]), np.array([5, 6, 5, 5])
    ends = alignment.group_ends([(0, 3, 0, 2, False), (3, 5, 2, 4, True)])
    assert [x.tolist() for x in ends] == [[3, 4, 5], [2, 3, 4]]
    want = [[0, 0, 0, 0, 0, 1], [15, 16, 25, 26, 35, 15], [2, 2, 1, 1, 1, 1]]
    for listed in (1, 100):
        monkeypatch.setattr(alignment, "LISTED", listed)
        assert [x.tolist() for x in alignment.linked_pairs(a, b, *ends, np.array([0, 0, 1]), 10)] == want


# Operator 12

def plain_runs(words, shortest=6, repeats=4):
    n, out, covered = len(words), [], []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i if j > i else 0
            if length >= max(shortest, repeats * q) and not any(
                    s <= i and i + length <= s + m and q % p == 0 for s, m, p in covered):
                out.append((i, length, q))
                covered.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    dropped = {k for s, m, q in found for k in range(s + q, s + m)}
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query(spark, documents):
    got = rows_of(queries.op12_periodic_runs(spark, DIR))
    assert got == sorted((plain_row(k, t) for k, t in documents), key=repr)


def test_runs_awkward(spark, awkward, tmp_path):
    got = rows_of(queries.op12_periodic_runs(spark, stored(awkward, tmp_path)))
    ids = [*range(len(TEXTS)), 4, None]
    assert got == sorted((plain_row(k, t) for k, t in zip(ids, [*TEXTS, TEXTS[4], "one two three four"])), key=repr)


def test_runs_empty(spark):
    assert runs.find_runs(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_lyndon_arrays(codes):
    for order in (codes, [3 - c for c in codes]):
        want = [next((j for j in range(i + 1, len(order)) if order[j:] < order[i:]), len(order)) - i
                for i in range(len(order))]
        assert runs.lyndon_lengths(order, 4) == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([(6, 4), (2, 2), (5, 3), (1, 2), (9, 2)]))
def test_periodic_runs(codes, least):
    assert runs.periodic_runs(np.array(codes, np.int64), *least) == plain_runs(codes, *least)


def test_runs_of_long_texts():
    random.seed(3)
    for period in (1, 7, 250):
        unit = [random.randrange(40) for _ in range(period)]
        codes = np.array([random.randrange(40) for _ in range(500)] + unit * (8000 // period) + [41, 42], np.int64)
        got = [r for r in runs.periodic_runs(codes) if r[1] > 5000]
        assert len(got) == 1 and got[0][2] == period and got[0][0] + got[0][1] == 500 + 8000 // period * period
    words = [b"w%d" % k for k in codes]
    assert len(runs.collapsed(words, [(0, 20, 2), (10, 30, 5)]).split()) == len(words) - 18 - 20


# Operator 13

def plain_print(text):
    words = (text or "").encode().lower().split()
    joined = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    values = [xxhash.xxh64_intdigest(s, seed=42) for s in joined]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))


def plain_components(ids, prints, distance=3):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, doc in enumerate(ids):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted(((doc, f"{p:016x}", least.get(find(k))) for k, (doc, p) in enumerate(zip(ids, prints))), key=repr)


def test_simhash_query(spark, documents):
    ids, prints = [k for k, _ in documents], [plain_print(t) for _, t in documents]
    assert rows_of(queries.op13_simhash(spark, DIR)) == plain_components(ids, prints)


def test_simhash_awkward(spark, awkward, tmp_path):
    texts = [*TEXTS, TEXTS[4], "one two three four"]
    got = rows_of(queries.op13_simhash(spark, stored(awkward, tmp_path)))
    assert got == plain_components([*range(len(TEXTS)), 4, None], [plain_print(t) for t in texts])
    assert [r[2] for r in got if r[0] in (0, 1, 2)] == [0, 0, 0]


def test_simhash_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (5, "quite another text")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr) == [
        (5, 5), (None, None), (None, None)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance, segments, block", [(3, 4, 1024), (3, 4, 7), (3, 8, 7), (5, 8, 16), (0, 1, 4), (7, 8, 5)])
def test_links_connect_like_all_pairs(spark, distance, segments, block, monkeypatch):
    """Chains of near prints, one hot group, far ones; small blocks and spans cut the cells."""
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = random.Random(distance * 100 + segments)
    prints = {rng.getrandbits(64) for _ in range(60)}
    hot = rng.getrandbits(64)
    for k in range(120):  # a hot group: few bits apart from one print
        x = hot
        for _ in range(rng.randrange(distance + 2)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    x = rng.getrandbits(64)
    for k in range(40):  # a chain
        for _ in range(max(distance, 1)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, distance, segments, block).collect()]
    assert all((a ^ b).bit_count() <= distance * len(prints) for a, b in edges)
    near = {k: k for k in prints}

    def find(k):
        while near[k] != k:
            k = near[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        near[max(a, b)] = min(a, b)
    want = plain_components(list(range(len(prints))), prints, distance)
    got = sorted(((k, f"{p:016x}", prints.index(find(p))) for k, p in enumerate(prints)), key=repr)
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3), st.sampled_from([4, 8, 16]))
def test_some_chain_is_viable(value, flipped, segments):
    other = value
    for k in flipped:
        other ^= 1 << k
    ring = simhash.Ring(3, segments)
    a, b = np.full(segments, value, np.uint64), np.full(segments, other, np.uint64)
    assert len(ring.viable(np.arange(segments), a, b))
    far = other ^ sum(1 << k for k in range(64) if k not in flipped and k % 2)
    assert not len(ring.viable(np.arange(segments), a, np.full(segments, far, np.uint64)))


# The pipeline decides by row

def test_stages_decide_by_row(spark):
    """Rows without id and repeated rows are judged by their own text."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, DIR).orderBy("doc_id").limit(3).collect()
    text = " ".join(f"plain{k}" for k in range(120))
    item = spark.read.parquet(f"{DIR}/benchmark.parquet").orderBy("item_id").first().text
    extra = [(None, text, "en", "web", 1), (900_001, text, "en", "web", 1), (900_001, text, "en", "web", 1),
             (None, "a b c", "en", "web", 1), (None, f"{text} {item}", "en", "web", 1), (None, good[0].text, "en", "web", 1),
             (None, "only here " + " ".join(f"x{k}" for k in range(90)), "en", "web", 1), (900_002, "", "en", "web", 0)]
    extra = spark.createDataFrame(extra, docs.schema)
    both = docs.unionByName(extra)

    def kept(df):
        return sorted((str(r.doc_id), r.text[:30]) for r in df.collect() if r.doc_id is None or r.doc_id > 900_000)

    judged = kept(corpus_pipeline.quality_rules(spark, both, DIR))
    assert ("None", "a b c") not in judged and ("900002", "") not in judged
    joined = kept(corpus_pipeline.ngram_jaccard_join(spark, both, DIR))
    assert joined.count(("900001", text[:30])) == 1
    # The copies without id are gone; the leaking text differs from the others by enough to stay.
    assert ("None", good[0].text[:30]) not in joined and ("None", "only here " + " ".join(f"x{k}" for k in range(90))[:20]) in joined
    left = kept(corpus_pipeline.benchmark_decontamination(spark, extra, DIR))
    assert left.count(("None", text[:30])) == 1 and left.count(("900001", text[:30])) == 2


# Operator 1: what its masks find

def found_share(n, changed):
    """Share of the placements of ``changed`` substitutions in ``n`` words after which some mask still fits."""
    hit = total = 0
    for places in combinations(range(n), changed):
        bad, total = set(places), total + 1
        hit += any(all(p + k not in bad for k, c in enumerate(m) if c == "1")
                   for m in decontaminate.masks_of(n) for p in range(n - len(m) + 1))
    return hit / total


@pytest.mark.parametrize("n", range(1, 24))
def test_masks_find_what_the_rule_accepts(n):
    """All windows an item of up to 16 words can match by; of longer items' windows nearly all."""
    for changed in range(n):
        if 100 * (n - changed) >= decontaminate.SHARE * n and n - changed and n <= decontaminate.WINDOW + 3:
            assert found_share(n, changed) == 1 if n <= decontaminate.SHORT else found_share(n, changed) > 0.98


def test_short_items_are_found_with_substitutions(spark):
    rng = random.Random(5)
    items, docs, want = [], [], set()
    for n in range(1, 17):
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for k in range(12):
            changed = rng.randrange(n // 2 + 1)
            own = list(item)
            for p in rng.sample(range(n), changed):
                own[p] = f"other{rng.randrange(10**9)}"
            words = [f"a{rng.randrange(10**9)}" for _ in range(rng.randrange(300))]
            docs.append((100 * n + k, " ".join(words + own + words[:5])))
            if 100 * (n - changed) >= 80 * n and n - changed:
                want.add((100 * n + k, n, len(words), n - changed))
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.first_word, r.n_equal) for r in got} == want


def test_only_empty_items(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, ""), (2, None)], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == 0
