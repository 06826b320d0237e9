"""Operators of maintlake.llm against brute force, round trips, planted cases and awkward tables."""

import collections
import hashlib
import itertools
import random
import re
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as registered
from maintlake.llm import (
    op1_mixing, op2_lines, op3_pieces, op4_secrets, op5_neighbours, op6_exact_topk, op7_quality, op8_substrings, op9_urls,
    op10_jaccard,
)
from maintlake.llm.links import components

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, stats string"


def table(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y") for i, t in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (None, "only words here"), (3, " \t\n "), (4, "a"), (5, "word " * 30000), (6, "a"), (6, "a"), (7, "x" * 20000)]


def prose(n, seed, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# --- 1 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("max_cells", [1000, 0])
def test_raking_reaches_the_targets(spark, max_cells):
    rng = random.Random(1)
    rows = [(i, rng.choice("aab"), rng.choice(["en", "de", None]), rng.randrange(1, 9)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_tokens long")
    out = op1_mixing.mix_sources(
        docs, {"source": {"a": 1, "b": 1}, "lang": {"en": 2, "de": 1, None: 1}}, 0.3, rounds=12, tolerance=1e-5, max_cells=max_cells
    ).toPandas()
    assert len(out) == 400
    raked = out.n_tokens * out.weight
    share = raked.groupby(out.source).sum() / raked.sum()
    assert abs(share["a"] - 0.5) < 1e-2
    assert abs(raked[out.lang.isna()].sum() / raked.sum() - 0.25) < 1e-2
    assert abs((out.n_tokens * out.probability).sum() / out.n_tokens.sum() - 0.3) < 1e-3
    assert not out.sampled.isna().any()


def test_mixing_takes_awkward_tables(spark):
    assert op1_mixing.mixed_documents(table(spark, AWKWARD)).count() == len(AWKWARD)
    assert op1_mixing.mixed_documents(table(spark, [])).count() == 0


# --- 2 ---------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def edited(text, n, rng):
    out = list(text)
    for _ in range(n):
        k, r = rng.randrange(len(out)), rng.random()
        if r < 0.4:
            out[k] = rng.choice("abcdü")
        elif r < 0.7:
            out.insert(k, rng.choice("abcdü"))
        else:
            out.pop(k)
    return "".join(out)


def test_banded_distance_and_keys_against_brute_force():
    rng = random.Random(2)
    for _ in range(4000):
        a = "".join(rng.choice("abü") for _ in range(rng.randrange(1, 16)))
        b = edited(a, rng.randrange(0, 5), rng) if len(a) > 6 else "".join(rng.choice("ab") for _ in range(4))
        for edits in (1, 2, 3):
            assert op2_lines.within(a, b, edits) == (distance(a, b) <= edits)


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ü") for _ in range(rng.randrange(22, 60))) for _ in range(25)]
    docs = []
    for i in range(40):
        lines = [edited(rng.choice(base), rng.randrange(0, 4), rng) if rng.random() < 0.8 else rng.choice(["", "ab", "abc"]) for _ in range(6)]
        docs.append((i, "\n".join(lines)))
    places = [(i, n, x) for i, t in docs for n, x in enumerate(t.split("\n")) if x.strip()]
    values = sorted({x for *_, x in places})
    leader = {x: x for x in values}

    def root(x):
        while leader[x] != x:
            x = leader[x]
        return x

    for a, b in itertools.combinations(values, 2):
        if min(len(a), len(b)) >= 20 and distance(a, b) <= 2:
            leader[root(a)] = root(b)
    first, gone = {}, collections.defaultdict(list)
    for i, n, x in sorted(places):
        if root(x) in first:
            gone[i].append(n)
        else:
            first[root(x)] = (i, n)
    got = {r.doc_id: list(r.removed) for r in op2_lines.repeated_lines(table(spark, docs)).collect()}
    assert got == {i: gone[i] for i, _ in docs}
    blocks = op2_lines.line_links(op2_lines.lined(table(spark, docs)), 2, 20, block_chars=150)
    assert sum(len(v) for v in got.values()) > 50 and blocks.count() > 0


def test_line_stage_keeps_columns_and_awkward_rows(spark):
    docs = table(spark, [*AWKWARD, (8, "one line of twenty chars or more\nnew"), (9, "one line of twenty chars or more\nother")])
    out = op2_lines.without_repeated_lines(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[9] == "other" and texts[8].startswith("one line") and 6 not in texts and texts[1] is None
    assert op2_lines.repeated_lines(table(spark, [])).count() == 0


# --- 3 ---------------------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(4)
    texts = ["", " ", "  a  b ", "▁a▁▁b", "<s> <unk> <0x41>", "\u0000a", "日本😀𝄞 é", " " * 200 + "x", "a" * 3000, "1,234.5²"]
    texts += ["".join(rng.choice("ab the ing▁\n\t012.,é日😀") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    codec = op3_pieces.Codec(op3_pieces.read_vocabulary(MODEL), cache_size=500)
    for text in texts:
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert codec.encode(text) == ids and codec.decode(ids) == model.decode(ids)
    for _ in range(2000):  # any ids, broken characters and controls in between
        ids = [rng.choice([0, 1, 2, 3 + rng.randrange(256), rng.randrange(32000)]) for _ in range(rng.randrange(1, 8))]
        assert codec.decode(ids) == model.decode(ids)
    rows = op3_pieces.encode_documents(table(spark, AWKWARD), MODEL).collect()
    assert len(rows) == len(AWKWARD)
    for row, (_, text) in zip(rows, AWKWARD):
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


# --- 4 ---------------------------------------------------------------------------------------------


def base_spans(text):
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def noisy(text, cls):
    out = []
    for m in re.finditer("[" + re.escape(cls.alphabet) + "]{%d,}" % cls.window, text):
        for i in range(m.start(), m.end() - cls.window + 1):
            counts = collections.Counter(text[i : i + cls.window]).values()
            if -sum(c / cls.window * np.log2(c / cls.window) for c in counts) >= cls.bits - 1e-9:
                if out and out[-1][1] >= i:
                    out[-1][1] = i + cls.window
                else:
                    out.append([i, i + cls.window])
    return out


def test_secrets_against_python(spark):
    rng = random.Random(5)
    parts = ["password: ", "TOKEN=", "api_key = '", "AKIA", "ü 😀 ", "token=token: ", "secret", "\n", "0123456789abcdef" * 2]
    letters = "abcdefABCDEF0123456789+/_-xyzXYZ"
    docs = list(AWKWARD)
    for i in range(150):
        pieces = [rng.choice(parts) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randrange(1, 50))) for _ in range(6)]
        docs.append((100 + i, rng.choice(["", " "]).join(pieces)))
    got = op4_secrets.secret_digest(table(spark, docs)).collect()
    assert len(got) == len(docs)
    free = op4_secrets.find_secrets(table(spark, docs), allow=()).collect()
    hits = 0
    for row, whole, (_, text) in zip(got, free, docs):
        spans = base_spans(text or "")
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert ",".join(s for s in row.spans.split(",") if not s.startswith("entropy")) == spans
        taken = [tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s]
        for cls in op4_secrets.CLASSES:
            want = [x for x in noisy(text or "", cls) if not any(s < x[1] and x[0] < e for s, e in taken)]
            assert [[s.start, s.end] for s in whole.found if s.kind == cls.kind] == want
            hits += len(want)
    assert hits > 20


def test_secrets_in_long_runs_and_many_matches(spark):
    """Runs over many blocks, with loud and quiet stretches that end on, before and after a block's edge."""
    rng = random.Random(8)
    loud = op4_secrets.CLASSES[1].alphabet
    runs = []
    for quiet in (30, 200, 256, 300):
        runs.append("".join(
            "".join(rng.choice(loud) for _ in range(rng.choice([24, 232, 256, 280, 400]))) + rng.choice("zQ7") * quiet
            for _ in range(8)
        ))
    many = " ".join(f"token={rng.randrange(10**rng.choice([6, 15])):x}x é" for _ in range(700))
    docs = [(i, t) for i, t in enumerate([*runs, many, many + runs[0], "data:image/png;base64," + runs[2]])]
    found = {r.doc_id: r.found for r in op4_secrets.find_secrets(table(spark, docs), allow=()).collect()}
    for i, text in docs:
        spans = base_spans(text)
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found[i] if s.rank < 3) == spans
        taken = [tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s]
        for cls in op4_secrets.CLASSES:
            want = [x for x in noisy(text, cls) if not any(s < x[1] and x[0] < e for s, e in taken)]
            assert [[s.start, s.end] for s in found[i] if s.kind == cls.kind] == want
        assert all(text[s.start : s.end] == s.value for s in found[i])


# --- 5 and 6 ---------------------------------------------------------------------------------------


def vectors(spark, n=600, seed=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)], "c") for i in range(n)]
    rows += [(n + i, rows[3][1], "c") for i in range(60)]
    rows += [(2000, None, "c"), (2020, [0.0] * 8, "c"), (2040, [float("nan")] * 8, "c"), (2060, [1.0], "c"), (None, rows[0][1], "c")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, entry string"), rows


def best(rows, nth, k, change=lambda x: x):
    good = [(i, change(np.array(v, float))) for i, v, _ in rows if i is not None and v and len(v) == 8 and np.isfinite(v).all()]
    out = {}
    for q, x in good:
        if q % nth == 0:
            ranked = sorted((-float(np.dot(x, y)), i) for i, y in good if i != q)
            out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


def test_multi_index_is_exact_over_all_cells_and_near_over_half(spark):
    frame, rows = vectors(spark)
    rows = [r for r in rows if r[0] is None or r[0] != 2020]  # zeros take no part
    want = best(rows, 20, 20)

    def found(**options):
        out = collections.defaultdict(list)
        for r in op5_neighbours.neighbours(frame, centroids_a_half=8, block_rows=50, query_rows=10, **options).orderBy("query_id", "rank").collect():
            out[r.query_id].append((r.vec_id, r.score))
        return out

    exact = found(share=1.0)
    assert exact.keys() == want.keys()
    for q in want:
        assert [i for i, _ in exact[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in exact[q]], [s for _, s in want[q]])
    near = found(share=0.5, least=1)
    hits = [len({i for i, _ in near[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    assert op5_neighbours.neighbours(frame.limit(0)).count() == 0


def test_sorted_lists_are_exact(spark):
    frame, rows = vectors(spark)
    want = best(rows, 100, 10, lambda x: np.floor(1024 * x))
    got = collections.defaultdict(list)
    for r in op6_exact_topk.exact_top(frame, block_rows=100, query_rows=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {q: [(i, int(s)) for i, s in v] for q, v in want.items()}
    assert op6_exact_topk.exact_top(frame.limit(0)).count() == 0


def test_recall_of_the_registered_search(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.stack(frame.embedding).astype(float)
    got = registered.queries()["op5_multi_index"](spark, SF).toPandas()
    hits = []
    for q in frame.vec_id[frame.vec_id % 20 == 0]:
        score = x @ x[frame.index[frame.vec_id == q][0]]
        score[frame.vec_id == q] = -np.inf
        hits.append(len(set(frame.vec_id[np.argsort(-score, kind="stable")[:20]]) & set(got.vec_id[got.query_id == q])) / 20)
    assert np.mean(hits) >= 0.9


def test_recall_of_a_stopped_walk(spark):
    """The registered parameters but ``least``, so that walks stop at half, on 64 dimensions."""
    rng = np.random.default_rng(7)
    tables = [np.stack(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas().embedding).astype(float)]
    tables.append(rng.normal(size=(9000, 64)))
    for x in tables:
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        got = op5_neighbours.neighbours(frame, least=1).toPandas().groupby("query_id").vec_id.agg(set)
        hits = []
        for q in range(0, len(x), 20):
            score = x @ x[q]
            score[q] = -np.inf
            hits.append(len(set(np.argsort(-score, kind="stable")[:20].tolist()) & got[q]) / 20)
        print(f"recall at half of {len(x)} vectors of {x.shape[1]} dimensions: {np.mean(hits):.4f} over {len(hits)} queries")
        assert 0.9 <= np.mean(hits) < 1


# --- 7 ---------------------------------------------------------------------------------------------


def test_pool_violators():
    assert op7_quality.pool_violators(np.ones(5), np.array([1, 3, 2, 2, 5.0])).tolist() == pytest.approx([1, 7 / 3, 7 / 3, 7 / 3, 5])


def test_quality_ranks_held_out_documents(spark):
    out = registered.queries()["op7_quality_score"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = out.merge(labels, on="doc_id").query("held_out")
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95
    assert out.score.between(0, 1).all() and ((out.score >= 0.3) == (out.predicted == 1)).all()


def test_quality_takes_awkward_tables(spark):
    labels = spark.createDataFrame([(4, 1), (4, None), (99, 0)], "doc_id long, quality int")
    assert op7_quality.score_quality(table(spark, AWKWARD), labels).count() == len(AWKWARD)
    assert op7_quality.score_quality(table(spark, []), labels.limit(0)).count() == 0


# --- 8 ---------------------------------------------------------------------------------------------


def kept_words(docs, window):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    seen, out = set(), {}
    for i in sorted(words):
        w, gone = words[i], set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    return out


def test_repeats_against_brute_force(spark):
    shared = [prose(60, s) for s in range(4)]
    docs = [(i, f"{prose(40, 50 + i)} {shared[i % 4]}\u00a0é {prose(30, 90 + i % 7)}\n{shared[(i + 1) % 4]}") for i in range(30)]
    docs += [(40, "a " * 400), (41, "b a " * 300), (42, docs[3][1]), (43, None), (44, ""), (45, " \n"), (46, "a b")]
    want = kept_words(docs, 20)
    for buckets in (1, 7):
        rows = op8_substrings.without_repeats(table(spark, docs), buckets=buckets, emit_text=True).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows} == want
    twice = op8_substrings.without_repeats(table(spark, [docs[0], docs[0], (None, docs[0][1])])).collect()
    assert sorted((r.doc_id is None, r.n_removed > 60) for r in twice) == [(False, False), (False, False), (True, True)]
    assert op8_substrings.without_repeats(table(spark, [])).count() == 0


# --- 9 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits, limit", [(10.0, 1 << 20), (4.0, 60)])
def test_cascade_is_exact(spark, bits, limit):
    rows = [(i, f"HTTP://a{i % 700}.Example.net/p?x={i}&utm_s=1" if i % 5 == 0 else f"http://a{i % 700}.example.net/p#t") for i in range(900)]
    rows += [(1000, None), (1001, "no scheme"), (1002, "x://example.org"), (1003, "x://www.example.org/en/12"), (1004, "://q.com/de/1?y")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = {r.page_id: r for r in op9_urls.filter_urls(pages, F.col("url").rlike(op9_urls.CAMPAIGN), bits_per_key=bits, max_filter_bytes=limit).collect()}
    listed = {i % 700 for i in range(0, 900, 5)}
    assert len(out) == len(rows)
    for i in range(900):
        assert out[i].host == f"a{i % 700}.example.net" and out[i].path == "/p" and out[i].rule is None
        assert out[i].verdict == ("block" if i % 700 in listed else "allow")
    assert (out[1000].host, out[1000].path, out[1001].host) == ("", "", "")
    assert (out[1002].rule, out[1003].rule, out[1004].rule) == (None, "example.org/en/1", "com/de/")
    assert op9_urls.filter_urls(pages.limit(0), F.lit(True)).count() == 0


# --- 10 --------------------------------------------------------------------------------------------


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


@pytest.mark.parametrize("block", [800_000, 300])
def test_jaccard_groups_against_brute_force(spark, block):
    rng = random.Random(8)
    docs = list(enumerate([None, "", "One two", "one TWO", "one", "one", "É x y z"]))
    for g in range(12):
        base = prose(rng.choice([20, 60, 150]), g, 3000).split()
        for _ in range(10):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(copy)))
    sets = {i: shingles(t, 4) for i, t in docs}
    group = {i: i for i, _ in docs}
    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        if a and b and 100 * len(a & b) >= 85 * len(a | b) and group[i] != group[j]:
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = {k: new if v == old else v for k, v in group.items()}
    out = op10_jaccard.jaccard_components(table(spark, docs), block_shingles=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == {i: (len(sets[i]), group[i]) for i, _ in docs}


def linked_groups(docs, size, percent):
    """The smallest id of each document's component, by all pairs."""
    sets = {i: shingles(t, size) for i, t in docs}
    group = {i: i for i in sets}
    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = {k: new if v == old else v for k, v in group.items()}
    return group


def extended(size, counts, seed):
    """Texts of so many shingles, each with a copy that has a word more: at the end, or at the front, or (long ones) inside."""
    docs = []
    for n in counts:
        for where in ("end", "front", "inside"):
            for k in range(3):
                words = [f"t{seed}_{n}_{where}_{k}_{x}" for x in range(n + size - 1)]
                at = {"end": len(words), "front": 0, "inside": len(words) // 2}[where]
                docs += [" ".join(words), " ".join([*words[:at], "more", *words[at:]])]
    return list(enumerate(docs))


def test_groups_of_texts_with_different_matches_against_brute_force(spark):
    docs = extended(4, (1, 2, 3, 6, 7, 12, 19, 20, 30, 40, 59, 60, 61, 90, 150, 300), 1)
    want = linked_groups(docs, 4, 85)
    assert len(docs) - len(set(want.values())) > 80
    for block in (800_000, 300):
        out = op10_jaccard.jaccard_components(table(spark, docs), block_shingles=block).collect()
        assert {r.doc_id: r.component_id for r in out} == want


def test_one_of_each_group_stays(spark):
    text = prose(80, 1)
    docs = table(spark, [(5, text), (3, text + " end"), (3, text + " end"), (9, prose(80, 2)), (1, None), (2, ""), (None, "a b")])
    out = op10_jaccard.one_of_each(docs, 5, Fraction(80, 100))
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 2), (False, 3), (False, 9), (True, 0)]
    assert op10_jaccard.jaccard_components(table(spark, [])).count() == 0


def test_pipeline_near_duplicates_against_brute_force(spark):
    import corpus_pipeline

    docs = extended(5, (1, 2, 4, 5, 14, 15, 30, 44, 45, 60, 100, 200), 2)
    rng = random.Random(9)
    for n in (9, 18, 40, 90):
        words = prose(n, n, 3000).split()
        for _ in range(8):
            words.insert(rng.randrange(len(words) + 1), f"n{rng.randrange(10**6)}")
            docs.append((len(docs), " ".join(words)))
    group = linked_groups(docs, 5, 80)
    assert len(docs) - len(set(group.values())) > 50
    out = corpus_pipeline.near_duplicates(spark, table(spark, docs), SF).collect()
    texts = dict(docs)
    assert {r.doc_id: r.text for r in out} == {i: texts[i] for i in group.values()} and len(out) == len(set(group.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}


@pytest.mark.parametrize("name", ["op6_sorted_lists", "op8_repeated_passages", "op9_url_filter", "op10_jaccard_groups"])
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = registered.queries()[name](spark, SF)
    wanted = duck.execute(registered.oracle_sql()[name])
    columns = sorted(found.columns)
    order = [[d[0] for d in wanted.description].index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in found.collect()) == sorted(repr([r[i] for i in order]) for r in wanted.fetchall())


# --- all -------------------------------------------------------------------------------------------


def test_pipeline_stages_chain(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = op1_mixing.saved(out)
        n = docs.count()
        assert 0 < n <= before, name
        before = n
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == before


def test_line_and_token_stages_against_python(spark):
    import corpus_pipeline

    rng = random.Random(10)
    base = ["".join(rng.choice("abcdefgh ü") for _ in range(rng.randrange(24, 50))) for _ in range(12)]
    docs = [(i, "\n".join(edited(rng.choice(base), rng.randrange(0, 3), rng) for _ in range(3))) for i in range(25)]
    values = sorted({x for _, t in docs for x in t.split("\n")})
    leader = {x: x for x in values}
    for a, b in itertools.combinations(values, 2):
        if distance(a, b) <= 2 and leader[a] != leader[b]:
            old, new = leader[a], leader[b]
            leader = {x: new if v == old else v for x, v in leader.items()}
    seen, want = set(), {}
    for i, t in docs:
        kept = []
        for x in t.split("\n"):
            if leader[x] not in seen:
                seen.add(leader[x])
                kept.append(x)
        if kept:
            want[i] = "\n".join(kept)
    assert 0 < len(want) < len(docs)
    out = corpus_pipeline.line_dedup(spark, table(spark, docs), SF)
    assert {r.doc_id: r.text for r in out.collect()} == want
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = {r.doc_id: list(r.token_ids) for r in corpus_pipeline.token_ids(spark, out, SF).collect()}
    assert ids == {i: model.encode(t, add_bos=True, add_eos=True) for i, t in want.items()}
