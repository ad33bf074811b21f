"""Conversation trie, decontamination and filter audit on small hand-made tables, against plain versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from stallbook.llm import conversation_trie, decontaminate, filter_audit, zfast

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


# op11


def plain_tree(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: t[:2])
    whole = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(t[2:] for t in [*convs.get(c - c % 20, [])[:h], *turns[h:]])
    members = collections.defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(SPACED.findall(p[-1][1])) if p else 0
            leaves[p[:d]] += not children[p]
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(map(str, sorted(c for c in m if whole[c] == p)))))
        for p, m in members.items()
    ]


def talks(seed, n=60, texts=3):
    """Few texts, so that many prefixes are shared; gaps in the ids, so that first conversations of families are missing."""
    rng = random.Random(seed)
    rows = []
    for c in [rng.randrange(400) for _ in range(n)]:
        if any(r[0] == c for r in rows):
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn if turn or rng.random() < 0.8 else None, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", None, "", "É x\x85y z"][: texts + 2])))
    rows += [(800 + i, t, "user", "same words here") for i in range(30) for t in range(6)]
    rows += [(700, t, "user", f"long {t % 7}") for t in range(50)] + [(709, t, "user", f"long {t % 7}") for t in range(45)]
    rows += [(None, 0, "user", "nobody")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,segment,batch", [(1, 2048, 500_000), (2, 4, 500_000), (3, 3, 20)])
def test_prefix_tree_against_plain_version(spark, seed, segment, batch):
    rows = talks(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int").repartition(3)
    assert sorted_rows(conversation_trie.prefix_tree(df, segment, batch).collect()) == sorted_rows(plain_tree(rows))


def test_prefix_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversation_trie.prefix_tree(empty).count() == 0
    # Only turnless conversations: the root is the one leaf.
    lone = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:5]
    rows = [(c, 0, "user", "x") for c in lone]
    assert [tuple(r) for r in conversation_trie.prefix_tree(spark.createDataFrame(rows, empty.schema)).collect()] == plain_tree(rows)


def test_repeated_turns_are_turns_of_their_own(spark):
    rows = [(0, 0, "user", "x")] * 3 + [(40, 1, "user", "y")] * 2 + [(40, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted_rows(conversation_trie.prefix_tree(df).collect()) == sorted_rows(plain_tree(rows))


def test_locate_finds_the_longest_shared_prefix():
    rng = random.Random(5)

    def keys(symbols):
        state, out = hashlib.md5(b""), b""
        for s in symbols:
            state.update(bytes([s]))
            out += state.digest()
        return out

    trie, seen = zfast.ZFastTrie(), []
    for label in range(300):
        base = rng.choice(seen)[: rng.randrange(1, 40)] if seen and rng.random() < 0.8 else []
        path = base + [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        trie.paths.append((0, keys(path)))
        if seen:
            shared = max(sum(1 for _ in itertools.takewhile(lambda ab: ab[0] == ab[1], zip(path, other))) for other in seen)
            node, depth = trie.locate(trie.roots[0, b""], len(trie.paths) - 1, len(path))
            assert depth == shared and trie.low[node] < depth <= trie.high[node] or depth == shared == trie.high[node]
        trie.paths.pop()
        trie.insert(0, b"", keys(path), label)
        seen.append(path)
    # Every node with a stretch is found under its handle, and only there.
    assert {n for n in trie.handles.values()} == {n for n in range(len(trie.low)) if trie.low[n] < trie.high[n]}
    count, least = trie.totals()
    assert count[trie.roots[0, b""]] == 300 and least[trie.roots[0, b""]] == 0


@pytest.mark.parametrize("low,high,wanted", [(0, 1, 1), (0, 7, 4), (4, 7, 6), (6, 7, 7), (3, 9, 8), (8, 11, 10)])
def test_two_fattest(low, high, wanted):
    assert zfast.two_fattest(low, high) == wanted


# op12


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[i : i + n])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if who := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= who
        yield doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta Eps zeta éta 中文 x9 tau".split())
    text = lambda n: rng.choice([" ", ", ", "-"]).join(word() for _ in range(n))
    items = [(i, text(rng.choice([3, 5, 9, 10, 11, 14, 30]))) for i in range(25)]
    items += [(30, items[0][1]), (30, items[0][1]), (31, "one"), (32, ""), (33, None), (None, text(12)), (34, "!!! ..")]
    docs = []
    for i in range(80):
        parts = [text(rng.choice([0, 2, 8, 40]))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words = plain_words(rng.choice(items)[1])
            cut = rng.randrange(len(words)) if rng.random() < 0.3 and words else 0
            parts += [" ".join(words[cut:]).upper() if rng.random() < 0.5 else " ".join(words[cut:]), text(rng.choice([0, 1, 12]))]
        docs.append((i, "\n".join(parts)))
    long = " ".join(["alpha beta"] * 20_000) + " " + items[6][1] + " " + items[6][1]
    docs += [(90, docs[3][1]), (3, docs[3][1]), (None, docs[4][1]), (91, None), (92, ""), (93, "?!"), (94, long), (95, "one")]
    return docs, items


# In a table of 64 bits nearly every bit is set by chance: only the joins decide.
@pytest.mark.parametrize("seed,bits", [(1, decontaminate.TABLE_BITS), (2, 64)])
def test_contamination_against_plain_version(spark, seed, bits):
    docs, items = passages(seed)
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, digest string").repartition(3)
    got = decontaminate.contamination(frame, spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, size int"), bits, slice_bytes=3_000)
    assert sorted_rows(got.collect()) == sorted_rows(plain_contamination(docs, items))


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert [tuple(r) for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [(1, 2, 0, 0, sha(""), False)]


@pytest.mark.parametrize("window", range(1, 11))
def test_winnowing_keeps_a_gram_of_every_window(window):
    rng = np.random.default_rng(window)
    hashes = rng.integers(0, 5, 400, dtype=np.uint64) * np.uint64(0x123456789ABCDEF1)
    lengths = np.array([150, 0, 3, 100, 147])
    places, prints = decontaminate.winnowed(hashes, lengths, window)
    kept, k, start = dict(zip(places.tolist(), prints.tolist())), decontaminate.kgram_size(window), 0
    for n in lengths:
        for i in range(start, start + n - window + 1):
            alone = decontaminate.winnowed(hashes[i : i + window], np.array([window]), window)
            at = i + int(alone[0][0])
            assert kept[at] == int(alone[1][0]) and at + k <= i + window
        start += n


# op13


def plain_audit(docs, labels):
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = collections.defaultdict(list)
    for doc, text, lang in docs:
        text = text or ""
        words = SPACED.findall(text)
        copy = text in least and (doc is None or doc > least[text])
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": copy}
        parts[lang or ""].append(({f for f in fails if fails[f]}, doc in good, doc in toxic))
    for part, rows in parts.items():
        shapley, out = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                before = set(order[:i])
                here = [r for r in rows if not r[0] & before]
                gone = [r for r in here if f in r[0]]
                shapley[f] += len(gone)
                out.append((part, "".join(order), i + 1, len(here) - len(gone), len(gone), sum(f in r[0] and bool(r[0] & before) for r in rows), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        yield from ((*row, shapley[row[1][row[2] - 1]]) for row in out)


def filtered(seed):
    rng = random.Random(seed)
    docs = []
    for i in range(120):
        n = rng.choice([0, 5, 199, 200, 260])
        text = " ".join(rng.choice(["w%d", "W%d", "x%d\t", "\x85%d"]) % rng.randrange(rng.choice([40, 4000])) for _ in range(n)) + rng.choice(["", "", " 5 %", "|"])
        docs.append((rng.randrange(200), text if rng.random() < 0.7 or not docs else rng.choice(docs)[1], rng.choice(["en", "de", None, ""])))
    docs += [(None, "", "en"), (None, docs[0][1], "de"), (None, "only here", "de"), (None, "only here", "de"), (500, None, None), (7, "twice", "en"), (7, "twice", "en"), (501, "A" * 90_000, "en")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in range(0, 200, 2)] + [(4, 1, 0), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_against_plain_version(spark, seed):
    docs, labels = filtered(seed)
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, lang string, mask string").repartition(3)
    got = filter_audit.filter_audit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert sorted_rows(got.collect()) == sorted_rows(plain_audit(docs, labels))


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.filter_audit(docs.limit(0), labels).count() == 0
    assert filter_audit.filter_audit(docs, labels).count() == 600


@pytest.mark.parametrize("k", range(1, 7))
def test_swaps_visit_every_order_once(k):
    order, seen = list(range(k)), {tuple(range(k))}
    for n, at in enumerate(filter_audit.swaps(k), 2):
        order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
        assert len(seen) == n
    assert len(seen) == len(list(itertools.permutations(range(k))))


def test_equal_sub_diagrams_are_shared():
    counts = {m: (1,) for m in range(32)}
    diagram = filter_audit.Diagram(5, counts, 1)
    assert len(diagram.branches) == 6 and diagram.weight[diagram.root] == (32,)
    diagram.swap(2)
    assert len(diagram.branches) == 6
