"""Importance resampling, token id files and conversation repair against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from samples import prose

from lumbung.llm import conversations, importance, token_files
from lumbung.session import stage, stage_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Importance resampling


def slow_features(text, ngrams):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [" ".join(words[i : i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)], len(words)


def slow_resample(docs, target, ngrams=1, buckets=10_000, seed=2024, least=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in slow_features(t, ngrams)[0])
    t = Counter(bucket(f) for x in target for f in slow_features(x, ngrams)[0])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    scored = []
    for i, text in docs:
        found, n_words = slow_features(text, ngrams)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    order = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = {id(r): i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return sorted([(*r[:4], drawn.get(id(r))) for r in scored], key=repr)


@pytest.mark.parametrize("ngrams", [1, 3])
def test_resampling_equals_brute_force(table, ngrams):
    docs = [(i, prose(i, 5 + 7 * i % 60)) for i in range(150)] + [(7, prose(7, 40))] * 3 + [(None, prose(1, 30)), (400, "ÉCOLE é 42 Z" * 30)]
    target = [prose(i, 40) for i in range(145, 165)] + [None, ""]
    bench = table([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = importance.resample(table(docs), bench, ngrams=ngrams, percent=30, buckets=500)
    assert rows(got) == slow_resample(docs, target, ngrams, 500, percent=30)


def test_resampling_of_odd_rows(odd, odd_rows, empty, table):
    bench = table([(1, prose(4, 200)), (2, None)], "item_id bigint, text string")
    got = importance.resample(odd, bench, percent=50)
    assert rows(got) == slow_resample([r[:2] for r in odd_rows], [prose(4, 200)], percent=50)
    assert rows(importance.resample(empty, bench)) == []
    nothing = table([], "item_id bigint, text string")
    assert rows(importance.resample(odd, nothing, percent=100)) == slow_resample([r[:2] for r in odd_rows], [], percent=100)
    kept = importance.draw(odd, bench, percent=50)
    assert kept.columns == odd.columns
    ids = {r[0] for r in slow_resample([r[:2] for r in odd_rows], [prose(4, 200)], percent=50) if r[4]}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in odd_rows if r[0] in ids)


def test_words_are_not_cut_between_chunks(monkeypatch):
    text = (prose(1, 200) + " " + "x" * 90 + " Ünï " + prose(2, 50)).encode()
    whole = list(importance.feature_buckets(text, 3, 1000))
    for size in (7, 20, 64):
        monkeypatch.setattr(importance, "CHUNK", size)
        parts = list(importance.feature_buckets(text, 3, 1000))
        assert len(parts) > 3 and sum(p[0] for p in parts) == whole[0][0]
        assert Counter(np.concatenate([p[1] for p in parts]).tolist()) == Counter(whole[0][1].tolist())


def test_ranks_are_exact_however_the_rows_are_cut(spark, monkeypatch):
    rng = random.Random(3)
    # A third of the rows share one id and score, another third share a score.
    data = [(5, 1, 30, 2, 100) for _ in range(2000)] + [(i, 1, 30, 2, 100) for i in range(2000)]
    data += [(rng.randint(-50, 50), 1, 30, 2, rng.randint(-500, 500)) for _ in range(2000)]
    rng.shuffle(data)
    scored = stage(
        spark.createDataFrame(data, "id bigint, n_features bigint, n_words bigint, weight bigint, score bigint")
        .repartition(7).withColumn("tie", F.monotonically_increasing_id()), "scores",
    )
    monkeypatch.setattr(importance, "RUN", 300)
    ranked = importance.rank_rows(scored, 40, segment=250)
    got = sorted((r["rank"], r["id"], r["score"]) for r in ranked.collect() if r["rank"])
    order = sorted(data, key=lambda r: (-r[4], r[0]))[: 40 * len(data) // 100]
    assert got == [(i + 1, r[0], r[4]) for i, r in enumerate(order)] and ranked.count() == len(data)
    runs = stage(importance.sorted_runs(scored), "runs")
    assert runs.count() >= 20
    cuts = importance.regular_splitters(runs, len(data), 250)
    sizes = [r[1] for r in importance.slices(runs, cuts, False).groupBy("segment").agg(F.sum("n")).collect()]
    assert len(cuts) == 23 and max(sizes) <= 3 * 250  # equal scores and ids do not fill a segment


# Token id files


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.MODEL))


ODD_TEXTS = [
    "", " ", "\n\n", "a\tb\x1cc\x1d d\x85e f g　h", "<|startoftext|>x <|endoftext|><|endoftext|>", "I'll they've 's'T ΟΔΟΣ ΣΑΣ",
    "é ́a 가 가", "漢字かな交じり文" * 40, "#", "# ## 2 \x00\x02", "İstanbul ﬁ Ⅷ ½", "x" * 500, "🎈👩‍👩‍👧 café\r\nnaïve",
]


def test_words_alone_have_the_ids_of_whole_texts(library):
    rng = random.Random(5)
    alphabet = [" ", " ", "\n", "\t", "\xa0", "\x1c", "a", "B", "é", "é", "́", "1", "²", "'s", "'", ".", "<|endoftext|>", "<|", "Σ", "ß", "ÿ", "À", "×", "ª", "!", ",", "漢", "🎈", "‍"]
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [f"{c} x{c} {c}! {c}{c}{c}." for c in map(chr, range(1, 0x250))]
    encode = token_files.Encoder(public_tokenizers.path(token_files.MODEL), cached=500)
    assert encode.words and len(encode.letters) == 26 + 32
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), encode.type).tolist() == want, text


def test_other_tokenizers_encode_whole_texts(table):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = token_files.Encoder(path)
    assert not encode.words
    plain = Tokenizer.from_file(path)
    for text in ["two  words", "a\n b"]:
        assert np.frombuffer(encode(text), encode.type).tolist() == plain.encode(text, add_special_tokens=False).ids


def slow_files(docs, library):
    found, start = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(found, key=repr)


def test_files_hold_the_ids(table, library):
    docs = [(3 * i, prose(i, 10 + i)) for i in range(100)] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(-5, None)]
    assert rows(token_files.write_and_read(table(docs))) == slow_files(docs, library)


def test_files_of_odd_rows(odd, odd_rows, empty, library):
    got = rows(token_files.write_and_read(odd))
    want = slow_files([r[:2] for r in odd_rows], library)
    # Rows that share an id stand together, in any order.
    single = [i for i, n in Counter(r[0] for r in odd_rows).items() if n == 1]
    assert [r for r in got if r[0] in single] == [r for r in want if r[0] in single]
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((r[0], r[2], r[3]) for r in want)
    assert sorted(r[1] for r in got)[0] == 0 and len({r[1] for r in got}) == len(got)
    assert rows(token_files.write_and_read(empty)) == []


def test_an_id_that_a_third_of_all_rows_share_fills_several_shards(spark, table, monkeypatch, library):
    docs = [(i, prose(i, 60)) for i in range(300)] + [(150, prose(1, 200))] * 4000 + [(151, prose(2, 300))] * 50
    folder = stage_path(spark, "ids")
    token_files.write_ids(table(docs), folder)
    shards = spark.read.parquet(f"{folder}/shards").orderBy("shard").collect()
    assert len(shards) >= 4 and max(r["ids"] for r in shards) < 0.6 * sum(r["ids"] for r in shards)
    assert sum(r["docs"] for r in shards) == len(docs)
    keys = spark.createDataFrame([(150,), (150,), (7,), (99_999,), (None,)], "doc_id bigint")
    got = token_files.fetch(spark, folder, keys).collect()
    assert Counter(r["doc_id"] for r in got) == {150: 4001, 7: 1}
    want = {i: {tuple(library.encode(t, add_special_tokens=False).ids) + (2,) for j, t in docs if j == i} for i in (7, 150)}
    assert all(tuple(r["ids"]) in want[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in got)
    starts = {r["start"]: r["n_tokens"] for r in got if r["doc_id"] == 150}
    assert max(starts) + starts[max(starts)] - min(starts) == sum(starts.values())  # they stand together


def test_a_file_holds_one_shard(spark, table, library):
    """Files are read as a whole, so several shards in one would have to fit into a task's memory together."""
    docs = [(i, prose(i % 50, 2000)) for i in range(500)] + [(1000, None), (1001, "x" * 500)]
    folder = stage_path(spark, "ids")
    token_files.write_ids(table(docs), folder)
    shards = spark.read.parquet(f"{folder}/shards").count()
    assert shards > 4 and token_files._files(spark, folder).count() == shards
    got = rows(token_files.fetch(spark, folder, table(docs).select("doc_id"), what="crc32"))
    assert got == slow_files(docs, library)


def test_a_word_seen_first_is_encoded_alone_and_long_ones_are_not_kept(library):
    encode = token_files.Encoder(public_tokenizers.path(token_files.MODEL), cached=3)
    for text in ["one two THREE four. four! " + "x" * 65 + " " + "Y" * 70 + ".", "one", "", "zwölf " * 3, "a1 " + "b2" * 40]:
        assert np.frombuffer(encode(text), encode.type).tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert max(map(len, encode.known)) <= token_files.CACHED_LENGTH
    assert len(encode.known) < 10  # forgotten in between


def test_words_that_differ_in_marks_or_case_share_their_pieces(library):
    """Words with their marks are many more than their pieces: each would be encoded and kept by itself."""
    marks = ["", "$$$", "###", ".***", ",", "'S", "'s", "1", "=a", "!?", "''ll"]
    text = " ".join(w + m for w in ("one", "One", "naïve", "NAÏVE") for m in marks)
    encode = token_files.Encoder(public_tokenizers.path(token_files.MODEL))
    assert np.frombuffer(encode(text), encode.type).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encode.known) < 24
    whole = ["one<|endoftext|>", "<|startoftext|>'s", "naïve…", "e\u0301a", "漢字.", "\x1ca", "ſ's"]
    for odd in whole:
        both = f"{text}\r\n\n {odd}\t{text}  {odd} \n"
        assert np.frombuffer(encode(both), encode.type).tolist() == library.encode(both, add_special_tokens=False).ids, odd
    assert len(encode.known) < 24 + len(whole)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False))
        hash_ = token_files.PerfectHash.build(keys)
        assert sorted(hash_.numbers(keys).tolist()) == list(range(len(keys)))
    entries = np.zeros(len(keys), token_files.ENTRY)
    entries["offset"], entries["fingerprint"] = np.arange(len(keys)), token_files.fingerprint(keys)
    part = token_files.Part(token_files.pack_part(keys, entries))
    there, found = part.find(keys)
    assert there.all() and (found["offset"] == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 64, 50_000, np.uint64, endpoint=False), keys)
    assert not part.find(others)[0].any()
    with pytest.raises(ValueError):
        token_files.PerfectHash.build(np.array([5, 5], np.uint64))


# Conversation repair

TURNS = "conv_id bigint, turn bigint, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?\Z")


def slow_repair(turns):
    """All edits of a conversation, by exhaustive search over audits of bounded length."""
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    turns = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in turns), key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for edits in itertools.product("KRD", repeat=len(turns)):
        cost, places = 0, []
        for (_, role, text), fault, edit in zip(turns, faults, edits):
            if fault in ("blank", "duplicate") and edit != "D":
                break
            cost += {"K": 0, "R": 2, "D": 3}[edit] + (fault == "truncated" and edit != "D")
        else:
            for inserts in itertools.product(range(4), repeat=len(turns) + 1):
                if 2 * sum(inserts) + cost > 3 * len(turns):
                    continue
                for result in shapes(turns, edits, inserts):
                    key = (cost + 2 * sum(inserts), result[0])
                    if best is None or key < best[0]:
                        best = key, result[1]
    (cost, audit), text = best
    known = [t for t, *_ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    count = Counter(faults)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def shapes(turns, edits, inserts):
    """(audit, text) for all roles of inserted and changed rows that give a legal conversation."""
    audit, slots = "", []
    for i, n in enumerate(inserts):
        slots += [(("user", ""), ("assistant", ""))] * n
        audit += "I" * n
        if i < len(turns):
            audit += edits[i]
            _, role, text = turns[i]
            if edits[i] == "K":
                slots.append(((role, text),))
            elif edits[i] == "R":
                slots.append((("user", text), ("assistant", text)))
    for chosen in itertools.product(*slots):
        if SHAPE.match("".join(r[:1] or "-" for r, _ in chosen)):
            yield audit, "\n".join(f"{r}:{t}" for r, t in chosen)


def random_conversations(seed, n, most):
    rng = random.Random(seed)
    texts = ["Yes.", "Yes.", "No!", "well", "", " \n", "why? ", "...", "a. b"]
    return [
        (c, rng.choice([None, i, i, i, 2 * i]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "unknown", None, ""]), rng.choice([*texts, None, f"t{i}."]))
        for c in range(n) for i in range(rng.randint(1, most))
    ]


def test_repair_equals_exhaustive_search(table):
    data = random_conversations(11, 150, 4) + [(None, 1, "user", "Hi."), (None, 2, "user", "there")]
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(table(data, TURNS)).collect()}
    for conv in {r[0] for r in data}:
        assert got[conv] == slow_repair([r[1:] for r in data if r[0] == conv]), [r for r in data if r[0] == conv]
    assert len(got) == 151


def plain_repair(turns):
    """The cheapest edits with whole audits as text in each state."""
    best = {0: (0, "")}

    def insert(best):
        for _ in range(4):
            for s, (c, a) in list(best.items()):
                t = {0: 2, 1: 2, 3: 2, 2: 3}[s]
                best[t] = min(best.get(t, (1 << 60, "")), (c + 2, a + "I"))

    insert(best)
    for initial, unfinished, must_go in turns:
        new = {}
        for s, (c, a) in best.items():
            offers = [(s, c + 3, "D")]
            if not must_go:
                offers.append(({0: 2, 1: 2, 3: 2, 2: 3}[s], c + 2 + unfinished, "R"))
                if (s, initial) in conversations.NEXT:
                    offers.append((conversations.NEXT[s, initial], c + unfinished, "K"))
            for t, cost, letter in offers:
                new[t] = min(new.get(t, (1 << 60, "")), (cost, a + letter))
        best = new
        insert(best)
    return min(best[s] for s in (0, 3) if s in best)


@pytest.mark.parametrize("most", [30, 100_000])
def test_linked_audits_equal_whole_texts(most):
    rng = random.Random(most)
    for n in [0, 1, 2, 3, 5, 8, 13, 40, 300] * 8:
        turns = [(rng.choice("suuaaax"), rng.random() < 0.3, rng.random() < 0.15) for _ in range(n)]
        if n == 40:
            turns = [("u", False, rng.random() < 0.8) for _ in range(n)]
        repair = conversations.Repair(most)
        for turn in turns:
            repair.add(*turn)
        assert repair.result() == plain_repair(turns)
        assert most > 30 or n < 300 or repair.done


def test_audits_with_equal_hashes_are_verified(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(conversations.Audits, "PRIME", 3)
    links = conversations.Audits()
    ends = [0]
    for _ in range(200):
        ends.append(links.append(rng.choice(ends), rng.choice("DK")))
    for a, b in itertools.product(rng.sample(ends, 40), repeat=2):
        if links.text(a) != links.text(b):
            assert links.less(a, b) == (links.text(a) < links.text(b))


def test_damaged_rows(table):
    data = [(c, t, "assistant", f"One. Two! {c}?") for c in range(40) for t in range(6)] + [(None, None, None, None), (1, None, None, "x.")]
    want = []
    for conv, turn, role, text in data:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case:
            text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
            want += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    assert rows(conversations.damage(table(data, TURNS))) == sorted(want, key=repr)


def test_repair_of_odd_rows(table):
    extra = {c: F.lit("extra") for c in ("conv", "digest", "place", "found", "audit", "n", "said", "COST")}
    data = [(1, 0, "user", "a."), (1, 0, "user", "a."), (None, None, None, None), (2, 1, "assistant", "x" * 200_000 + "."), (2, 0, "user", None)]
    source = table(data, TURNS)
    plain = rows(conversations.repair(source))
    assert rows(conversations.repair(source.withColumns(extra))) == plain
    assert {r[0]: r[7] for r in plain} == {1: "KDI", 2: "DIK", None: "D"}
    ids = table([(9, 0, None, None), (1, 0, None, None)], TURNS)
    empty_hash = hashlib.sha256(b"").hexdigest()
    assert (9, 0, 0, 0, 0, 0, 0, "", empty_hash) in rows(conversations.repair(source, ids))
    assert rows(conversations.repair(table([], TURNS))) == []
    assert rows(conversations.repair(table([], TURNS), ids.select("conv_id"))) == [(c, 0, 0, 0, 0, 0, 0, "", empty_hash) for c in (1, 9)]


def test_repaired_rows_have_the_digest(table):
    source = table(random_conversations(5, 60, 12), TURNS)
    texts = {}
    for conv, place, role, text, edit in sorted((tuple(r) for r in conversations.repaired(source).collect()), key=lambda r: r[:2]):
        assert edit != "I" or text == ""
        texts.setdefault(conv, []).append(f"{role}:{text}")
        assert place == len(texts[conv]) - 1
    for r in conversations.repair(source).collect():
        assert hashlib.sha256("\n".join(texts.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_a_conversation_with_a_third_of_all_rows(table):
    rng = random.Random(8)
    data = [(7, i // 3, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"{i}."])) for i in range(3000)]
    data += [(7, 5000, "user", "again.")] * 2000 + [(100 + i, 0, "user", "Hi.") for i in range(3000)]
    got = {r["conv_id"]: r for r in conversations.repair(table(data, TURNS)).collect()}
    assert len(got) == 3001 and len(got[7]["audit"].replace("I", "")) == 5000 and got[7]["duplicate"] >= 1999
