"""Near-duplicates, exact repeats, line repeats, decontamination, pieces and the pipeline against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, line_dedup, pieces, shingle_sets, simhash, suffix_dedup
from tidemark.llm.components import components
from tidemark.llm.queries import MODEL, QUERIES

FULL = (1 << 64) - 1
WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "Eta", "theta", "日本", "kappa", "x1", "mu"]


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def grouped(nodes, edges):
    """Smallest member of each node's component."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(low[a], low[b])
            if low[a] != least or low[b] != least:
                low[a] = low[b] = least
                changed = True
    return low


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(tokens[i: i + 4]) for i in range(max(1, len(tokens) - 3))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "One", "one", "a b c", "A B C d", "É x y z q", "long " * 30_000]
    for _ in range(12):
        base = words(rng, 400).split(" ")
        texts.append(" ".join(base))
        for _ in range(4):
            near = list(base)
            for at in rng.sample(range(400), rng.randint(0, 6)):
                near[at] = rng.choice(WORDS)
            texts.append(" ".join(near))
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    prints = {k: brute_fingerprint(t) for k, t in rows}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    low = grouped(prints, near)
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id bigint, text string, fingerprint string")
    out = simhash.near_duplicates(docs.repartition(3)).collect()
    assert {(r.doc_id, r.fingerprint & FULL, r.component_id) for r in out} == {(k, prints[k], low[k]) for k in prints}
    assert len(set(low.values())) < len(low)
    twice = simhash.near_duplicates(spark.createDataFrame([(3, "a"), (3, "a"), (None, "a"), (2, None)], "doc_id int, text string"))
    assert sorted((r.doc_id or 0, r.component_id) for r in twice.collect()) == [(0, 3), (2, 2), (3, 3), (3, 3)]
    assert simhash.near_duplicates(docs.where("1 = 0")).collect() == []


@pytest.mark.parametrize("tile", [2, 20_000])
def test_anchors_join_every_pair_within_reach(spark, tile):
    rng = np.random.default_rng(1)
    values = set()
    for base in rng.integers(0, FULL, 20, dtype=np.uint64).tolist():
        for _ in range(8):
            flips = rng.choice(64, rng.integers(0, 6), replace=False).tolist()
            values.add(base ^ sum(1 << f for f in flips))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint bigint"), tile=tile)
    edges = [(r.src, r.dst) for r in found.collect()]
    reach = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & FULL).bit_count() <= 4]
    assert all(((a ^ b) & FULL).bit_count() <= 4 for a, b in edges)
    assert grouped(signed, edges) == grouped(signed, reach)


def brute_set(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(tokens[i: i + 5]) for i in range(max(1, len(tokens) - 4))} if tokens else set()


def brute_jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pipeline_links_all_pairs_of_shingle_jaccard(spark, monkeypatch):
    monkeypatch.setattr(shingle_sets, "TILE", 7)
    rng = random.Random(12)
    texts = [None, "", " \n", "one", "One", "a b c d e f", "a b c d e g"]
    for n in (9, 60, 300):
        for _ in range(6):
            base = [f"w{rng.randint(0, 500)}" for _ in range(n)]
            for _ in range(9):
                near = list(base)
                for at in rng.sample(range(n), rng.randint(0, n // 40 + 2)):
                    near[at] = f"v{rng.randint(0, 500)}"
                texts.append(" ".join(near))
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    sets = {k: brute_set(t) for k, t in rows}
    similar = {p: brute_jaccard(sets[p[0]], sets[p[1]]) for p in itertools.combinations(sets, 2)}
    low = grouped(sets, [p for p, x in similar.items() if x >= 0.8])
    apart = [p for p, x in similar.items() if 0.8 <= x < 1 and (brute_fingerprint(texts[p[0] - 10]) ^ brute_fingerprint(texts[p[1] - 10])).bit_count() > 4]
    assert len(apart) > 50 and any(0.6 < x < 0.8 for x in similar.values())
    docs = spark.createDataFrame([(k, t, None, "s", 0, "c", True, 0) for k, t in rows], DOCS).repartition(3)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert {r.doc_id for r in out.collect()} == set(low.values())


def test_pipeline_keeps_different_texts_of_one_doc_id(spark):
    rng = random.Random(30)
    a, b, c = (" ".join(f"{x}{rng.randint(0, 900)}" for _ in range(80)) for x in "abc")
    rows = [(7, a), (7, b), (7, b), (None, c), (None, c), (None, b), (8, a + " tail")]
    docs = spark.createDataFrame([(k, t, None, "s", 0, "c", True, 0) for k, t in rows], DOCS)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(((r.doc_id or 0), r.text) for r in out.collect()) == sorted([(7, a), (7, b), (0, c)])


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r.component for r in components(chain, "src", "dst").collect()} == {1}


def brute_repeats(rows, length=50):
    first = {}
    raw = [(k, (t or "").encode()) for k, t in rows]
    for key, text in raw:
        for i in range(len(text) - length + 1):
            window = text[i: i + length]
            first[window] = min(first.get(window, key), key)
    out = {}
    for key, text in raw:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if first[text[i: i + length]] < key:
                gone[i: i + length] = b"\1" * length
        runs = sum(1 for g, _ in itertools.groupby(gone) if g)
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        out[key] = (len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("parts, shard_bytes", [(1, 2 << 20), (7, 500)])
def test_suffix_dedup(spark, parts, shard_bytes):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [letters(n) for n in (45, 50, 51, 80, 200, 700)] + ["ab" * 60, "z" * 130]
    texts = [None, "", "short", "z" * 400, "ab" * 200, "\0" * 60, "\0" * 90]
    for _ in range(60):
        parts_ = [letters(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            parts_ += [passage[rng.randint(0, 9): len(passage) - rng.randint(0, 9)], letters(rng.randint(0, 40))]
        texts.append("".join(parts_))
    texts += texts[-3:]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id bigint, text string, spans int").repartition(parts)
    out = suffix_dedup.remove_repeats(docs, shard_bytes=shard_bytes).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out}
    assert len(out) == len(rows) and got == brute_repeats(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out)
    assert suffix_dedup.remove_repeats(docs.where("1 = 0")).collect() == []


def test_an_anchor_in_many_surroundings_is_dealt_by_window(spark, monkeypatch):
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    phrase, ends = letters(40), [letters(12) for _ in range(6)]
    texts = [letters(60) + (rng.choice(ends) if i % 3 else letters(12)) + phrase + rng.choice(ends) + letters(60) for i in range(60)]
    rows = list(enumerate(texts))
    whole = suffix_dedup.shard_windows

    def bounded(anchors, docs, cuts, length):
        assert sum(map(len, cuts)) < 2 * 500, "a shard of unbounded size"
        return whole(anchors, docs, cuts, length)

    monkeypatch.setattr(suffix_dedup, "shard_windows", bounded)
    run = suffix_dedup._shards
    monkeypatch.setattr(suffix_dedup, "_shards", lambda n, size: _with_bound(run(n, size), bounded))
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), shard_bytes=500).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out}
    assert got == brute_repeats(rows) and any(x[1] for x in got.values())


def _with_bound(run, bounded):
    def checked(batches):
        suffix_dedup.shard_windows = bounded  # in the worker process
        yield from run(batches)

    return checked


def test_copies_within_a_batch():
    a = np.array
    got = suffix_dedup.copies_within(a([5, 5, 5, 5, 1]), a([7, 7, 7, 8, 7]), a([3, 2, 2, 9, 4]))
    assert got.tolist() == [True, False, False, False, False]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup(spark):
    rng = random.Random(3)
    bases = ["".join(rng.choice("abcdefgh é日") for _ in range(rng.randint(38, 60))) for _ in range(8)] + ["ab" * 25]

    def edited():
        line = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(line))
            kind = rng.randrange(3)
            line[at: at + (kind != 0)] = [] if kind == 1 else [rng.choice("xyz")]
        return "".join(line)

    texts = [None, "", "\n\n", " \n\t", "same\nsame", "same"]
    texts += ["\n".join(rng.choice([edited(), "short", "", "  "]) for _ in range(rng.randint(1, 8))) for _ in range(30)]
    rows = list(enumerate(texts))
    lines = [(k, i, x) for k, t in rows for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\v\f")]
    first = {}
    for k, i, x in lines:
        first.setdefault(x, (k, i))
    near = {
        x for x in first if len(x) >= 40
        and any(len(y) >= 40 and first[y] < first[x] and distance(x, y) <= 2 for y in first)
    }
    equal = {(k, i) for k, i, x in lines if first[x] != (k, i)}
    close = {(k, i) for k, i, x in lines if x in near} - equal
    assert equal and close
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id bigint, text string, doc int").repartition(3)
    out = line_dedup.repeated_lines(docs).collect()
    assert {(r.doc.key, i) for r in out for i in r.equal_lines} == equal
    assert {(r.doc.key, i) for r in out for i in r.near_lines} == close
    kept = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs).collect()}
    for k, t in rows:
        gone = {i for d, i in equal | close if d == k}
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        assert kept.get(k) == (left if not gone or left.strip(" \t\r\v\f\n") else None)
    assert line_dedup.repeated_lines(docs.where("1 = 0")).collect() == []


def brute_hits(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    own, hit, names = split(text), set(), set()
    for item, content in items:
        w = split(content)
        for window in {tuple(w[i: i + 10]) for i in range(max(1, len(w) - 9))} if w else ():
            for at in range(len(own) - len(window) + 1):
                if tuple(own[at: at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    names.add(str(item))
    return len(own), len(hit), sorted(names)


@pytest.mark.parametrize("block_windows", [5, 1 << 18])
def test_decontamination(spark, block_windows):
    rng = random.Random(2)
    items = [(1, None), (2, "?!"), (3, "Mu"), (4, "alpha BETA"), (5, "x1 x1 x1"), (10, words(rng, 10))]
    items += [(k, words(rng, rng.randint(9, 25))) for k in range(11, 20)] + [(30, words(rng, 12))] * 2
    texts = [None, "", "...", "mu", "alphabeta alpha, beta", "x1 " * 2000, "Mu" * 5000]
    for _ in range(30):
        passage = rng.choice(items[5:])[1].split(" ")
        at = rng.randint(0, 4)
        texts.append("-".join([words(rng, rng.randint(0, 15)), " ".join(passage[at: at + rng.randint(8, 20)]), words(rng, 5)]))
    docs = spark.createDataFrame([(t, "own") for t in [*texts, *texts[:9]]], "text string, contamination string")
    found, name = decontaminate.find_contamination(
        docs, spark.createDataFrame(items, "item_id bigint, text string"), block_windows=block_windows
    )
    got = sorted(((r.text, *(r[name].n_words, r[name].n_hit, list(r[name]["items"]))) for r in found.collect()), key=repr)
    assert got == sorted(((t, *brute_hits(t, items)) for t in [*texts, *texts[:9]]), key=repr)
    none, name = decontaminate.find_contamination(docs, spark.createDataFrame([], "item_id bigint, text string"))
    assert none.where(F.col(name)["n_hit"] > 0).count() == 0


def test_pieces_equal_the_library(spark):
    rng = random.Random(4)
    alphabet = "abcdeéßÆ日本語한🙂 ▁ ..,,;'\"\n\t012²½ªTHEthe"
    texts = [None, "", " ", "   x  ", "a" * 3000, "hello world", "​", "日本語" * 400, "word " * 20_000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(200)]
    docs = spark.createDataFrame([(t, "own") for t in texts], "text string, piece_ids string").repartition(3)
    model = pieces.read_model(MODEL)
    coded, ids = pieces.encode(docs, model)
    back, text = pieces.decode(coded, model, ids)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = back.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert list(r[ids]) == library.encode(r["text"] or "")
        assert r[text] == (r["text"] or "").replace("▁", " ")
    assert pieces.encode(docs.where("1 = 0"), model)[0].collect() == []


def test_viterbi_finds_the_best_segmentation():
    rng = random.Random(8)
    known = sorted({"".join(rng.choice("abc▁") for _ in range(rng.randint(2, 4))) for _ in range(40)} | set("abc▁"))
    score = {p: -rng.random() * 9 for p in known}
    model = pieces.Model(True, ("<unk>", *known), (0.0, *score.values()), (2, *[1] * len(known)), False, False)
    for _ in range(60):
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 9)))
        form = text.replace(" ", "▁")
        best = {0: 0.0}
        for end in range(1, len(form) + 1):
            best[end] = max(best[s] + score[form[s:end]] for s in range(end) if form[s:end] in score)
        chosen = [model.pieces[i] for i in pieces.Encoder(model).encode([text])[0]]
        assert "".join(chosen) == form
        assert sum(score[p] for p in chosen) == pytest.approx(best[len(form)])


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, near boolean, _document int"


def test_pipeline_stages_on_hard_rows(spark):
    sf_dir = "/root/testdata/sf0.001"
    rng = random.Random(6)
    prose = " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(300))
    rows = [(1, None), (2, ""), (3, prose), (3, prose), (None, prose), (4, prose + " tail"), (None, None), (5, "x " * 50_000)]
    docs = spark.createDataFrame([(k, t, None, "s", len(t or ""), "c", True, 0) for k, t in rows], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert stage(spark, docs.where("1 = 0"), sf_dir).count() == 0, name
        kept = sorted(((r.doc_id or 0), r.text) for r in out.where("text is not null").collect())
        if name == "near_duplicates":
            sets = {k: brute_set(t) for k, t in rows if k is not None}
            edges = [(a, b) for a, b in itertools.combinations(sets, 2) if brute_jaccard(sets[a], sets[b]) >= 0.8]
            assert {k for k, _ in kept} | {1} == set(grouped(sets, edges).values())
        if name == "decontamination":
            assert len(kept) == len([t for _, t in rows if t is not None])


def test_pipeline_keeps_what_its_operators_keep(spark):
    sf_dir = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf_dir).collect()
    keys = [r.doc_id for r in out]
    good = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, sf_dir).where("kept").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert len(keys) == len(set(keys)) > 0 and set(keys) <= good
    sets = [brute_set(r.text) for r in out]
    assert all(brute_jaccard(a, b) < 0.8 for a, b in itertools.combinations(sets, 2))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in out:
        assert brute_hits(r.text, items)[1] == 0 and r.n_chars == len(r.text)
        assert list(r.piece_ids) == library.encode(r.text) and r.n_pieces == len(r.piece_ids)
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    lines = [line for r in out for line in r.text.split("\n") if line.strip()]
    assert len(lines) == len(set(lines))
