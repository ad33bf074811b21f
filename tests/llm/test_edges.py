"""Repeats, clashing columns and odd arguments in nearest-neighbour search and chat formatting; the language model by itself."""

import collections
import json
import math
import random
import zlib

import numpy as np

from stallbook.llm import ann, chat, ngram_lm


def test_repeated_queries_are_asked_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    other = rng.normal(size=6).tolist()
    table = [*rows, rows[10], rows[10], rows[20], (20, other), rows[31], rows[31]]
    frame = spark.createDataFrame([(*r, 1) for r in table], "vec_id bigint, embedding array<double>, _asker int")
    got = ann.nearest(frame, frame.vec_id % 10 == 0, share=1.0).collect()

    def plain(query, vector):
        near = sorted((float(np.sqrt(((np.array(v) - np.array(vector)) ** 2).sum())), i) for i, v in table if i != query)[:10]
        return [(query, rank, i) for rank, (_, i) in enumerate(near, 1)]

    wanted = [row for q in range(0, 60, 10) for row in plain(q, rows[q][1])] + plain(20, other)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(wanted)


def test_odd_arguments_are_reported_not_raised(spark):
    deep = "[" * 5_000 + "]" * 5_000
    bodies = ['{"question": "\\ud800 x"}', '{"question": ' + deep + "}", '{"question": ' + "[" * 600 + "]" * 600 + "}", "no json", '{"question": "x", "after": 3}', '{"question": null}']
    rows = [("1", i, "call", str(i), "reply", b) for i, b in enumerate(bodies)]
    events = spark.createDataFrame(rows, "conv_id string, turn int, kind string, event_id string, name string, body string")
    schemas = {"reply": {"type": "object", "properties": {"question": {"type": ["string", "null"]}, "after": {"type": "object"}}}}
    found = {r["turn"]: r for r in chat.linked(events, schemas).collect()}
    assert json.loads(found[0]["line"])["arguments"]["question"] == "\ud800 x" and not found[0]["errors"]
    assert found[1]["errors"] == ["arguments are nested too deeply"] and found[2]["errors"] in (["arguments are nested too deeply"], [".question: not string or null"])
    assert found[3]["errors"] == ["arguments are not JSON"] and "after" in found[4]["errors"][0] and not found[5]["errors"]


def test_equal_numbers_have_equal_bytes():
    assert chat.canonical(1e16) == chat.canonical(10**16) == "10000000000000000" and chat.canonical(1.0) == "1" and chat.canonical(0.5) == "0.5"


def test_clashing_columns_of_conversations(spark):
    rows = [(1, 0, "user", "q", 5, 5, 5), (1, 1, "assistant", "a", 5, 5, 5), (1, 1, "assistant", "a", 5, 5, 5)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, _c int, _t int, _asked int")
    assert sorted(r["kind"] for r in chat.turns_as_calls(table).collect()) == ["call", "result", "result"]


def test_scores_do_not_hang_on_the_size_of_lists_and_shards(spark, monkeypatch):
    rng = random.Random(8)
    names = [f"w{i}" for i in range(5000)]
    weights = [1 / (i + 1) for i in range(5000)]
    texts = [" ".join(rng.choices(names, weights, k=rng.choice((0, 1, 60, 300)))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)

    def scored(known_words, shard_tokens):
        monkeypatch.setattr(ngram_lm, "KNOWN_WORDS", known_words)
        monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard_tokens)
        return {r["doc_id"]: (r["base_score"], r["score"]) for r in ngram_lm.scores(docs).collect()}

    # the list of frequent words holds all of them, or those that come ten times
    everything = scored(10**6, 10**7)
    for known_words, shard_tokens in ((ngram_lm.CONTEXTS, 5000),):
        found = scored(known_words, shard_tokens)
        assert found.keys() == everything.keys()
        for i, (base, score) in found.items():
            assert abs(base - everything[i][0]) < 1e-6
            assert abs(score - everything[i][1]) < 1e-3 * (len(texts[i].split()) + 1)  # codes of 16 bits


def test_contexts_are_divided_by_their_share_of_the_tokens(monkeypatch):
    def parts(times, shard_tokens):
        monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard_tokens)
        model = ngram_lm.Unigrams(900_000 * times, 3, 10 * times, 10**6 * times, [(7, 50_000 * times, 60_000 * times), (9, 0, 3 * times)])
        return model.parts(np.array([7, 9, 11])).tolist()

    assert parts(1, 2_000_000) == parts(1, 100) == parts(5000, 2_000_000)
    assert parts(1, 100)[1:] == [1, 1]


def test_scores_against_a_plain_kneser_ney_model(spark):
    """Every step of the model in plain Python, with contexts divided as the module says."""
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdefghij", range(1, 11), k=rng.choice((1, 5, 30)))) for _ in range(120)]
    got = {r["doc_id"]: r["score"] for r in ngram_lm.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    tokens = [[*t.split(), None] for t in texts]
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = collections.Counter(x for t, o in zip(tokens, out) if not o for x in t)
    everywhere = collections.Counter(x for t in tokens for x in t)
    whole = sum(c.values()) + len(c) + 1
    ident = {None: ngram_lm.END, **{x: ngram_lm.word_id(x.encode()) for x in "abcdefghij"}}

    def context(u, v):
        parts = max(1, -(-everywhere[v] * ngram_lm.CONTEXTS // sum(everywhere.values())))
        before = np.array([(ident[u] if u else ngram_lm.NO_WORD) & ngram_lm.SHORT])
        return v, int(ngram_lm.mixed(before, 3)[0] % parts) if parts > 1 else 0

    grams = [[(t[i - 1] if i else "", t[i], t[i + 1]) for i in range(len(t) - 1)] for t in tokens]
    count = collections.Counter(g for gs, o in zip(grams, out) if not o for g in gs)
    by_uv, kinds_uv, kinds, total, followers = (collections.Counter() for _ in range(5))
    for (u, v, w), n in count.items():
        by_uv[u, v] += n
        kinds_uv[u, v] += 1
        total[context(u, v)] += 1
        followers[context(u, v)] += not kinds[context(u, v), w]
        kinds[context(u, v), w] += 1

    def p(u, v, w):
        q, at, d = (c[w] + 1) / whole, context(u, v), ngram_lm.DISCOUNT
        p2 = max(kinds[at, w] - d, 0) / total[at] + d * followers[at] / total[at] * q if total[at] else q
        return max(count[u, v, w] - d, 0) / by_uv[u, v] + d * kinds_uv[u, v] / by_uv[u, v] * p2 if by_uv[u, v] else p2

    for i, t in enumerate(tokens):
        base = sum(math.log10((c[x] + 1) / whole) for x in t)
        model = math.log10((c[t[0]] + 1) / whole) + sum(math.log10(p(*g)) for g in grams[i])
        top = max(base, model)
        want = top + math.log10((10 ** (base - top) + 10 ** (model - top)) / 2)
        assert abs(got[i] - want) < 1e-3 * len(t)
