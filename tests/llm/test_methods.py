"""What the operators promise beyond small tables: whole conversations, word identity, filters, every letter, held-out figures."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import bpe, chat, common, exact_dedup, factorisation, language_model, mixing, near_dedup, sharding

TURNS = [("assistant" if n % 2 else "user", f"text {n}") for n in range(150)]


@pytest.mark.parametrize("bad", [1, 29, 64, 99, 128, 149])
def test_a_rewrite_at_any_turn_is_caught(bad):
    def template(turns):
        return "".join(f"[{r}]{'' if len(turns) == bad + 1 and i == 0 else t}" for i, (r, t) in enumerate(turns))

    whole, found, at = chat.spans(TURNS, template)
    assert at == bad and len(found) == bad and whole == template(TURNS)


def test_turns_are_read_from_the_text(spark):
    turns = [("us<|nl|>er\n", "a <|im_end|>\n<|im_start|>b"), ("assistant", r"<\|im_end|>"), (chat.MARKER, chat.MARKER), ("", "")]
    whole, found, bad = chat.spans(turns)
    assert bad is None and [(r, t) for r, t, _, _ in chat.parsed(whole)] == turns
    assert [whole[a:b] for _, _, a, b in chat.parsed(whole)] == [chat.escape(t) for _, t in turns]
    for broken in (whole[1:], whole[:-1], whole.replace("<|im_start|>assistant", "<|im_start|>assistant<|x"), chat.START + "user\n" + "a <|im_start|> b" + chat.END + "\n"):
        with pytest.raises(ValueError):
            chat.parsed(broken)


def test_words_of_any_form_are_told_apart():
    word = b"a"
    for _ in range(12):
        word += bytes(b ^ 3 for b in word)  # Thue-Morse over a and b
        other = bytes(b ^ 3 for b in word)
        assert common.words(word)[0] != common.words(other)[0]
    assert (common.words(b"Ab ab") == common.words(b"aB AB")).all() and len(common.words(b" \n")) == 0 and common.words(b"Ab", lower=False)[0] != common.words(b"ab")[0]
    long = b" ".join(b"w%d" % i for i in range(200_000))
    assert len(long) > 4 * common.PIECE and len(np.unique(common.words(long))) == 200_000


def test_repeated_ids_with_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " x"), (3, b + " x"), (4, "c d e"), (4, "c d e"), (5, None)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(docs).collect())
    assert got == [(1, 56, 1, True), (1, 56, 1, True), (2, 57, 1, False), (3, 57, 1, False), (4, 1, 4, True), (4, 1, 4, True), (5, 0, 5, True)]
    kept = near_dedup.kept_documents(docs.withColumn("__x", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "__x"] and sorted(r.doc_id for r in kept.collect()) == [1, 1, 4, 4, 5]


def test_rare_shingles_lose_no_pair(spark):
    """Sets of very different overlaps: every pair at the limit comes out, and few others."""
    rng = random.Random(2)
    base = [rng.sample(range(1000 * k, 1000 * k + 300), 60) for k in range(4)]
    sets = [sorted({*(x for x in base[i % 4] if rng.random() > 0.06), *rng.sample(range(10_000), rng.randint(0, 5))}) for i in range(80)]
    rows = spark.createDataFrame([(i, len(s), s) for i, s in enumerate(sets)], "node bigint, n bigint, extra array<bigint>")
    for percent in (80, 85):
        want = {(a, b) for a in range(80) for b in range(a) if 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})}
        met = near_dedup.by_rare_shingles(rows.select("node", F.col("node").alias("root")), rows, percent)
        got = {(r.v, r.u) for r in met.collect()}
        assert want and want <= got
        assert {(r.u, r.v) for r in near_dedup.verified(met.select(F.col("v").alias("u"), F.col("u").alias("v")).distinct(), rows, percent).collect()} == want


def test_runs_are_merged_through_filters():
    rng = random.Random(4)
    rows = [(bytes([rng.randrange(256) for _ in range(3)]) + b"\0", rng.randrange(100), uid) for uid in range(3000)]
    index, want = exact_dedup.DigestIndex(4, memtable=100, fanout=3), {}
    for d, i, uid in rows:
        index.add(d, True, i, uid)
        want.setdefault(d, []).append(i)
    assert len(index.levels) > 1
    whole = index.compact()
    assert len(whole) == len(want) and (np.sort(whole.rows["digest"]) == whole.rows["digest"]).all()
    assert all(index.get(d)[0] == min(ids) and index.get(d)[2] == len(ids) for d, ids in want.items())
    cut = exact_dedup._slices(whole, 7)
    assert sum(len(e) for e in cut.column(1).to_pylist()) == whole.rows.nbytes and cut.column(0).to_pylist() == sorted(set(cut.column(0).to_pylist()))


def test_filters_let_few_texts_through(spark):
    docs = spark.createDataFrame([(i, f"text {i}" if i % 50 else "Copy") for i in range(2000)], "doc_id bigint, text string")
    hits = exact_dedup.build_index(exact_dedup.fingerprints(docs))
    assert [(r.n, r.doc_id) for r in hits.collect()] == [(40, 0)]
    assert 1 <= exact_dedup.suspects(docs.coalesce(1), hits).count() < 20
    plan = exact_dedup.kept_documents(docs)
    assert sorted(r.doc_id for r in plan.collect()) == [i for i in range(2000) if i % 50 or i == 0]
    gone = spark.createDataFrame([(7, 1), (None, 1)], "k bigint, n bigint")
    rows = spark.createDataFrame([(7,), (8,), (None,)], "id bigint")
    assert [r.id for r in common.without(rows, gone, [F.col("id")], ["k"], "n").collect()] == [8]
    assert sorted(str(r.id) for r in common.within(rows, gone, [F.col("id")], ["k"]).collect()) == ["7", "None"]


def test_joins_with_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 4)
    rows = spark.range(100).select("id", F.when(F.col("id") < 60, "hot").when(F.col("id") < 90, F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("key"))
    table = rows.groupBy(F.col("key").alias("t_key")).agg(F.count("*").alias("n")).filter("t_key is null or t_key <> 'k3'")
    got = common.keyed_join(rows, table, [("key", "t_key")], "n", 100).collect()
    want = Counter(r.key for r in rows.collect())
    assert len(got) == 100 and all(r.n == (None if r.key == "k3" else want[r.key]) for r in got)
    assert common.keyed_join(rows, table, [("key", "t_key")], "n", 100, "inner").count() == 100 - want["k3"]


def test_every_code_point():
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.Tokenizer.from_file(bpe.default_path())
    with open(bpe.default_path(), "rb") as file:
        own = bpe.Bpe(file.read())
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}+{chr(c)}" for c in range(at, at + 64) if not 0xD800 <= c < 0xE000) for at in range(0, 0x110000, 64)]
    for at in range(0, len(texts), 1000):
        some = texts[at : at + 1000]
        want = [np.array(e.ids, "<u4").tobytes() for e in model.encode_batch(some, add_special_tokens=False)]
        assert own.encode(some) == want


def test_targets_by_resharing():
    """The plain loop: give every open source its weight, close those above their limit, share the excess again."""
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 5, 50, 1000]) for _ in range(rng.randint(1, 7))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        left, want, open_ = 1.5 * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
        while open_ and left > 1e-9:
            total = sum(weights[i] for i in open_)
            given = {i: want[i] + left * weights[i] / total for i in open_}
            left = 0.0
            for i in list(open_):
                want[i] = min(given[i], 2 * sizes[i])
                left += given[i] - want[i]
                if given[i] >= 2 * sizes[i]:
                    open_.discard(i)
        assert mixing.targets(sizes) == pytest.approx(want, abs=1e-6)


def test_shards_with_a_large_group_and_repeated_rows(spark):
    rows = [(i, "same text" * 20) for i in range(700)] + [(900 + i, "x" * (i % 300)) for i in range(600)] + [(5, "row " * 50)] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sharding.shard(docs, 8).collect()
    held = Counter()
    for r in got:
        held[r.shard] += r.size
    total = sum(held.values())
    assert len(got) == len(rows) and all(0.8 * total / 8 < held[k] < 1.2 * total / 8 for k in range(8))
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


def test_scores_against_a_dense_machine(spark):
    """Scores of the operator equal those of the whole vector of features, pair by pair."""
    rng = np.random.default_rng(0)
    machine = factorisation.Machine(seed=3)
    machine.w, machine.bias = rng.normal(0, 0.3, machine.w.shape), 0.1
    texts = ["", None, "Some words, some WORDS!\nline # two", "a b c " * 30]
    docs = spark.createDataFrame([(i, t, None if i == 1 else len(t or "")) for i, t in enumerate(texts)], "doc_id bigint, text string, n_chars bigint")
    for r in factorisation.score(docs, machine).collect():
        text = (texts[r.doc_id] or "").encode()
        at, x = factorisation.features(text, common.words(text), None if r.doc_id == 1 else len(texts[r.doc_id] or ""))
        dense = np.zeros(len(machine.w))
        dense[at] = x
        pairs = sum(dense[i] * dense[j] * (machine.v[i] @ machine.v[j]) for n, i in enumerate(at) for j in at[n + 1 :])
        assert r.score == pytest.approx(1 / (1 + math.exp(-(machine.bias + machine.w @ dense + pairs))))


def test_scores_beat_base_and_bigram_on_held_out_texts(spark):
    """Words follow words of the next kind, each in its own measure; pairs of rare words are mostly new."""
    rng = random.Random(6)
    kinds = [[f"k{k}w{i}" for i in range(60)] for k in range(4)]
    text = lambda: " ".join(rng.choice(kinds[(k + s) % 4]) for s in [rng.randrange(4)] for k in range(rng.randint(20, 60)))
    rows = [(i, text()) for i in range(1500)]
    got = language_model.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    words = {i: ["", *t.split(), ""] for i, t in rows}
    train = [i for i in words if zlib.crc32(str(i).encode()) % 7 != 2]
    one, two = Counter(w for i in train for w in words[i][:-1]), Counter(p for i in train for p in zip(words[i], words[i][1:]))
    held = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    bigram = sum(math.log10((two[p] + 1) / (one[p[0]] + len(one) + 1)) for r in held for p in zip(words[r.doc_id], words[r.doc_id][1:])) / tokens
    score, base = sum(r.score for r in held) / tokens, sum(r.base_score for r in held) / tokens
    assert held and score > base + 0.1 and score > bigram


def test_language_model_is_normalised_and_the_same_on_other_partitions(spark):
    total = np.arange(1, 3001, dtype=float)
    m = language_model.Model(total, 3)
    norm = m.log_norm(np.arange(3000))
    s = m.context[[7]] @ m.target.T + m.bias
    assert np.exp(s - norm[7]).sum() == pytest.approx(1, abs=1e-4)
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(rng.choice("abcdefgh") for _ in range(30))) for i in range(200)], "doc_id bigint, text string")
    one, two = ({r.doc_id: r.score for r in language_model.score(docs.repartition(n)).collect()} for n in (1, 5))
    assert one == pytest.approx(two)


def test_stages_of_the_pipeline_against_brute_force(spark):
    import corpus_pipeline as p

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    texts = []
    for _ in range(12):
        own = [word() for _ in range(rng.randint(3, 80))]
        texts.append(" ".join(own))
        texts += [" ".join(own).upper()] * rng.randint(0, 2)
        for _ in range(rng.randint(0, 3)):
            near = list(own)
            near[rng.randrange(len(near))] = word()
            texts.append(" ".join(near))
    rows = [(100 + i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate([None, "", *texts])]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault((t or "").lower(), []).append(i)
    exact = {max(ids) for ids in groups.values()}
    left = p.exact(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == sorted(exact)
    by = {i: (t or "").lower().split() for i, t, _ in rows if i in exact}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in by.items()}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    near = p.near(spark, left, "")
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i in root if root[i] == i)
    copies = {r.doc_id: r.copies for r in mixing.mix(near).collect()}
    mixed = p.mix(spark, near, "")
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})
    tokens = p.tokenize(spark, mixed, "").collect()
    assert len(tokens) == sum(copies.values()) and all(r.round_trip and r.n_tokens * 4 == len(r.ids) for r in tokens)
    assert hashlib.sha256(b"").hexdigest() in {hashlib.sha256(bytes(r.ids)).hexdigest() for r in tokens} or not any(copies[i] for i in copies if not by[i])


def test_components_of_hubs_and_odd_edges(spark, monkeypatch):
    """Hubs go by broadcast, other nodes by a shuffle; nulls, loops and repeated edges as stated."""
    from clinlake.llm import common, graph

    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 40)
    rng = random.Random(4)
    edges = [(0, n) for n in range(1, 1_500)] + [(5_000 + n, 5_001 + n) for n in range(60)] + [(rng.randrange(6_000, 6_400), rng.randrange(6_000, 6_400)) for _ in range(150)]
    edges += [(None, 3), (7, None), (9_999, 9_999), (0, 1), (1, 0)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    table = spark.createDataFrame([(u, v, "x") for u, v in edges], "u bigint, v bigint, m string").repartition(5)
    got = graph.components(table).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert graph.components(table.limit(0)).count() == 0


def test_long_conversations_stay_linear_in_escaping(monkeypatch):
    from clinlake.llm import chat

    calls, escape = [], chat.escape
    monkeypatch.setattr(chat, "escape", lambda text: calls.append(1) or escape(text))
    turns = [("user" if n % 2 == 0 else "assistant", f"turn {n} <|") for n in range(4_500)]
    formatted, spans, bad = chat.spans(turns)
    assert bad is None and len(spans) == 4_500 and len(calls) <= 5 * 4_500
    assert [t[:2] for t in chat.parsed(formatted)] == turns


def test_lines_of_a_host_of_many_texts_are_still_marked(spark):
    """Above 20,000 texts of a host the limit is a share: planted lines in more than that are boilerplate, those in fewer are not; both parameters are free."""
    from clinlake.llm import line_quality

    often, seldom = "a licence line that many texts share", "a line of a few texts only"
    rows = [(n, f"text {'abcdefgh'[n % 8]} number-{n * 7919 % 100_003:x}-{n:x} of this host\n" + (often if n < 60 else seldom if n < 82 else ""), "h") for n in range(21_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    gone = {r.doc_id for r in line_quality.cleaned(docs).filter("boilerplate_words > 0").collect()}
    assert set(range(60)) <= gone and (set(range(60, 82)) <= gone) == (22 > 21_000 * line_quality.SHARE)
    strict = {r.doc_id for r in line_quality.cleaned(docs, min_docs=70, share=0.0).filter("boilerplate_words > 0").collect()}
    assert not strict & set(range(82))


def test_stages_of_an_empty_table(spark):
    import corpus_pipeline

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = documents.limit(0)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.count() == 0, name
        assert n == len(corpus_pipeline.STAGES) - 1 or out.columns == documents.columns


def test_encoding_of_an_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id bigint, text string"), bpe.load(spark, bpe.default_path())).count() == 0
