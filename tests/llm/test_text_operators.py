"""Token counts, language, quality, toxicity and benchmark leaks."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from samples import prose

from lumbung.llm import bpe, langid, spaced, toxicity, weak


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(bpe.MODEL))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Token counts


def test_counts_are_those_of_the_library(library):
    rng, count = random.Random(5), bpe.Counter(bpe.load(public_tokenizers.path(bpe.MODEL)))
    texts = ["", " ", "  ", " a", "a  b ", "▁a", "a▁▁b", "<s>x</s>", "a\r\n  b\t", "\x00", "①", "語" * 50, "🎈 x", "ab" * 5000, " " * 300]
    texts += ["".join(rng.choice("abe  ▁\n\té①語.<s>") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    assert [count(t) for t in texts] == [len(library.encode(t)) for t in texts]


def test_counts_with_a_small_cache(library):
    count = bpe.Counter(bpe.load(public_tokenizers.path(bpe.MODEL)), cached=10)
    for seed in range(5):
        assert count(prose(seed, 50)) == len(library.encode(prose(seed, 50)))


def test_token_counts_of_odd_rows(odd, odd_rows, empty, library):
    got = rows(bpe.count_tokens(odd, limit=100))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for i, t, *_ in odd_rows]
    assert got == sorted(want, key=str)
    assert rows(bpe.count_tokens(empty)) == []


def test_a_vocabulary_whose_pieces_span_words_is_refused():
    with pytest.raises(ValueError):
        bpe.Merges({"a": 0.0, "▁": 0.0, "a▁": -1.0})


# Language


def segmentations(word):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        for rest in segmentations(word[i:]):
            yield [word[:i], *rest]


def test_forward_sums_all_segmentations():
    pieces = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "ba": 5}
    table = np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.2], [0.05, 0.1], [0.15, 0.3], [0.2, 0.1], [0.001, 0.002], [0, 0]])
    for word in ("a", "ab", "abab", "aqb"):
        got = langid.Lattices(pieces, [word]).forward(table)[-1][0]
        want = np.zeros(2)
        for parts in segmentations("▁" + word):
            ids = [pieces.get(p, 6 if len(p) == 1 else 7) for p in parts]
            want += np.prod(table[ids], axis=0)
        assert np.allclose(got, want)


def test_expected_counts_weigh_all_segmentations():
    pieces = {"▁": 0, "a": 1, "b": 2, "ab": 3}
    table = np.array([[0.25], [0.25], [0.25], [0.25], [0.0], [0.0]])
    sums = np.zeros(4)
    for _, ids, n in langid.Lattices(pieces, ["ab"]).expected(table, np.array([0]), np.array([10.0])):
        np.add.at(sums, ids, n)
    assert np.allclose(sums, [10, 2, 2, 8])  # ▁,a,b has 1/64 and ▁,ab has 1/16


TOY = {"en": "the cat and the dog of this house with that", "de": "der hund und die katze nicht auch auf einem haus", "fr": "le chat et les chiens dans une maison pour vous"}


def toy_documents(n=60):
    out = []
    for i in range(n):
        lang = list(TOY)[i % 3]
        rng = random.Random(i)
        out.append((i, " ".join(rng.choice(TOY[lang].split()) for _ in range(30)), lang, "src1", 1))
    return out


def test_languages_of_held_out_texts(table):
    docs = toy_documents()
    got = {r["doc_id"]: r for r in langid.identify(table(docs)).collect()}
    for i, _, lang, *_ in docs:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == lang and 0.9 < got[i]["score"] <= 1


def test_held_out_languages_are_never_read(table):
    docs = toy_documents()
    held = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    changed = [(i, t, "xx" if i in held else lang, *r) for i, t, lang, *r in docs]
    assert rows(langid.identify(table(docs))) == rows(langid.identify(table(changed)))


def test_language_of_odd_rows(odd, odd_rows, empty, table):
    got = langid.identify(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5))
    assert all(0 <= r["score"] <= 1 and isinstance(r["held_out"], bool) for r in got)
    assert rows(langid.identify(empty)) == []
    assert rows(langid.identify(table([(1, "word", None, None, None)]))) == [(1, False, "und", 0.0)]


# Quality


def slow_measures(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    inside = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside))


def test_measures_of_odd_texts(odd, odd_rows):
    texts = [t for _, t, *_ in odd_rows] + ["a b c a b c", "a a a a", "a\na\n a\n\n \n", "x y z", "##|<", "é é é é"]
    for t in texts:
        assert weak.measure(t.encode() if t is not None else None)[:5] == slow_measures(t), t and t[:50]
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice("ab  \n#") for _ in range(rng.randint(0, 60)))
        assert weak.measure(t.encode())[:5] == slow_measures(t), t


def test_quality_of_odd_rows(odd, odd_rows, empty):
    got = weak.judge(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd_rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert 0 <= r["quality"] <= 1 and not (r["base_failed"] and r["kept"])
    assert rows(weak.judge(empty)) == []


def test_good_rows_stay_with_all_columns(odd, empty):
    kept = weak.keep_good(odd)
    assert kept.columns == odd.columns
    want = [r["doc_id"] for r in weak.judge(odd).where("kept").collect()]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want) and 1 in want
    assert all(r["__row"] == "extra __row" for r in kept.collect())
    assert weak.keep_good(empty).collect() == []


def test_label_model_finds_the_bad_texts(table):
    good = [(i, prose(i, 100), "en", "s", 1) for i in range(60)]
    bad = [(100 + i, " ".join(w + "###" for w in prose(i, 100).split()), "en", "s", 1) for i in range(8)]
    bad += [(200 + i, prose(i, 100).upper().replace(" ", "!! "), "en", "s", 1) for i in range(8)]
    got = {r["doc_id"]: r["kept"] for r in weak.judge(table(good + bad)).collect()}
    assert got == {i: i < 100 for i in got}


def test_label_model_without_votes_or_texts():
    assert weak.fit_label_model(np.zeros((0, 3)), np.zeros(0)).prior == pytest.approx(weak.PRIOR)
    model = weak.fit_label_model(np.array([[2, 2, 2], [0, 2, 2]]), np.array([1000, 30]))
    assert model.weights[0][0] < 0 < model.prior


# Toxicity


def toxic_documents(n=160):
    out, labels = [], []
    for i in range(n):
        text = prose(i, 60)
        if i % 4 == 0:
            text = text.replace(" ", f" {('nastyword', 'nastyish', 'vilething')[i % 3]} ", 3)
        out.append((i, text, "en", "src1", 1))
        labels.append((i, 1, int(i % 4 == 0)))
    return out, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_toxic_texts_are_found(table):
    docs, labels = toxic_documents()
    got = toxicity.score(table(docs), table(labels, LABELS)).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], int(r["doc_id"] % 4 == 0)) for r in got if r["held_out"]]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_held_out_labels_are_never_read(table):
    docs, labels = toxic_documents(60)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    assert rows(toxicity.score(table(docs), table(labels, LABELS))) == rows(toxicity.score(table(docs), table(flipped, LABELS)))


def test_toxicity_of_odd_rows(odd, odd_rows, empty, table):
    labels = table([(1, 1, 1), (1, 1, 0), (2, 1, None), (None, 1, 1), (6, 1, 0), (9, 0, 1), (99, 1, 1)], LABELS)
    got = toxicity.score(odd, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd_rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert rows(toxicity.score(empty, labels)) == []
    none = toxicity.score(odd, table([], LABELS)).collect()
    assert len({r["score"] for r in none}) == 1


# Benchmark leaks

ITEM = prose(77, 40)
BENCH = "item_id bigint, text string"


def changed(text, every):
    return " ".join("other" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def slow_leak(text, item, window=20, share=0.8, least=8):
    """The largest overlap, or None if the item is not in the text."""
    doc, own = spaced.tokens((text or "").lower()), spaced.tokens((item or "").lower())
    width = min(window, len(own))
    best = max((
        sum(doc[p + i] == own[q + i] for i in range(width)) / width
        for p in range(len(doc) - width + 1)
        for q in range(len(own) - width + 1)
    ), default=0) if own else 0
    return best if own and best >= (share if len(own) >= least else 1) else None


def test_passages_with_substitutions_are_found(table):
    texts = {1: ITEM, 2: prose(5, 50) + " " + ITEM.upper() + " " + prose(6, 50), 3: changed(ITEM, 6), 4: changed(ITEM, 5), 5: changed(ITEM, 3), 6: prose(8, 300), 7: " ".join(ITEM.split()[:12]), 8: "is it Too-short?", 9: "too very short"}
    docs = table([(i, t) for i, t in texts.items()])
    # One id has two items.
    items = [(10, ITEM), (11, prose(78, 30)), (12, "too short"), (10, " ".join(ITEM.split()[5:30])), (13, " .")]
    bench = table([*items, (None, ITEM), (13, None), (10, ITEM)], BENCH)
    got = {r["doc_id"]: r for r in spaced.find_leaks(docs, bench, ["doc_id"]).collect()}
    for i, t in texts.items():
        want = {}
        for n, x in items:
            if (share := slow_leak(t, x)) is not None:
                want[n] = max(share, want.get(n, 0))
        assert got[i]["item_ids"] == sorted(want) and got[i]["overlaps"] == [want[n] for n in sorted(want)], i
        assert got[i]["contaminated"] == bool(want)
    assert [got[i]["contaminated"] for i in range(1, 10)] == [True, True, True, True, False, False, False, True, False]
    blocks = spaced.find_leaks(docs, bench, ["doc_id"], block_bytes=100)
    assert rows(blocks) == rows(spaced.find_leaks(docs, bench, ["doc_id"]))


def test_passes_do_not_grow_with_the_blocks(table, monkeypatch):
    docs, bench = table([(1, prose(3, 40))]), table([(i, prose(i, 30)) for i in range(200)], BENCH)
    found = spaced.find_leaks(docs, bench, ["doc_id"], block_bytes=2500)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 3
    monkeypatch.setattr(spaced, "PASS", 3)
    assert rows(spaced.find_leaks(docs, bench, ["doc_id"], block_bytes=2500)) == rows(found) == [(1, True, [3], [1.0])]


def test_every_allowed_substitution_leaves_a_seed():
    for window, share, least in ((20, 0.8, 8), (10, 0.6, 4)):
        for n in range(1, window + 1):
            item = [f"w{i}" for i in range(n)]
            index = spaced.Index([(1, " ".join(item))], window, share, least)
            allowed = next(k for k in range(n, -1, -1) if (n - k) / n >= (share if n >= least else 1))
            texts = []
            for places in itertools.combinations(range(n), allowed):
                changed_ = [("other" if i in places else w) for i, w in enumerate(item)]
                texts.append(" ".join(changed_))
            assert index.find(texts) == [{1: (n - allowed) / n}] * len(texts), n


def test_random_substitutions_and_short_items_equal_brute_force():
    rng = random.Random(6)
    words = [f"t{i}" for i in range(12)]
    for _ in range(400):
        item = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 10, 14, 15, 19, 20, 21, 30]))]
        text = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        copy = [rng.choice([*words, "other"]) if rng.random() < 0.22 else w for w in item]
        text = text + copy[rng.randint(0, 3) :] + text[:9]
        [found] = spaced.Index([(1, " ".join(item))], 20, 0.8, 8).find([" ".join(text)])
        share = slow_leak(" ".join(text), " ".join(item))
        assert found == ({} if share is None else {1: share}), (item, text)


def test_parts_of_long_texts_and_unspaced_scripts(monkeypatch):
    index = spaced.Index([(1, ITEM), (2, "漢字仮名交じり文")], 20, 0.8, 8)
    text = prose(5, 300) + " " + changed(ITEM, 7) + " " + prose(6, 200) + " これは漢字仮名交x文です"
    [whole] = index.find([text])
    others = ["これは漢字仮名交じり文です", "漢字仮名交じり句", "漢字仮名交じ", "", ITEM]
    assert set(whole) == {1} and [set(f) for f in index.find(others)] == [{2}, {2}, set(), set(), {1}]
    for size in (1, 40, 333):
        monkeypatch.setattr(spaced, "PART", size)
        assert index.find([text]) == [whole]


def test_leaks_of_odd_rows(odd, odd_rows, empty, table):
    bench = table([(1, prose(4, 200)), (2, prose(1, 120))], BENCH)
    kept = spaced.drop_leaks(odd, bench)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, *_ in odd_rows if i not in (1, 2, 9))
    assert spaced.drop_leaks(odd, table([], BENCH)).count() == len(odd_rows)
    assert spaced.find_leaks(empty, bench, ["doc_id"]).collect() == []
    assert spaced.find_leaks(odd, bench, ["doc_id"]).where(F.col("contaminated")).count() == 4


# Samples that training is bounded by


def test_copies_of_a_text_count_once_in_the_language_sample(table, monkeypatch):
    """A text with a third of all rows neither fills the sample nor keeps others out."""
    docs = [(4 * i, prose(i, 12), "en", "s", 1) for i in range(120)] + [(4 * i, prose(1, 12), "en", "s", 1) for i in range(500, 560)]
    docs += [(4 * i, f"der hund {i} und die katze {i}", "de", "s", 1) for i in range(700, 760)]
    seen, own = [], langid._word_counts
    monkeypatch.setattr(langid, "_word_counts", lambda df, lang, text: seen.append(df) or own(df, lang, text))
    langid.fit(table(docs), "lang", "text", public_tokenizers.path(langid.MODEL), 60, 1)
    texts = Counter((r["lang"], r["body"]) for r in seen[0].collect())
    assert set(texts.values()) == {1}
    sizes = Counter(lang for lang, _ in texts)
    assert 35 <= sizes["en"] <= 85 and sizes["de"] == 60


def test_rows_that_share_an_id_count_once_in_the_toxicity_sample(table, monkeypatch):
    docs, labels = toxic_documents(60)
    docs += [(1, prose(1000 + i, 30), "en", "s", 1) for i in range(300)]
    shown = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: shown.append(texts) or toxicity.Network.start(1))
    toxicity.score(table(docs), table(labels, LABELS))
    known = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5]
    assert len(shown[0]) == len(known)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 16 * 800)
    toxicity.score(table(docs), table(labels, LABELS))
    assert 0 < sum(len(t) for t in shown[1]) <= 2 * 800 and 0 < len(shown[1]) < len(known)
    whole = {t.tobytes() for t in shown[0]}
    assert all(t.tobytes() in whole for t in shown[1])  # fewer texts, none is cut


# The classifier by plain loops


def slow_logit(net, ids):
    """Convolution over every place of a text, then the largest value of each filter."""
    padded = [*ids, *[0] * toxicity.PAD]
    vector = lambda b: net.embedding[b >> 32].astype(float) + net.embedding[b & 0xFFFFFFFF].astype(float)
    pooled = []
    for bank, bias in zip(net.filters, net.bias):
        for f in range(toxicity.FILTERS):
            places = range(len(ids) + 1)  # the padding behind a text has a place too
            values = [sum(vector(padded[p + j]) @ bank[j, :, f].astype(float) for j in range(len(bank)) if p + j < len(padded)) + bias[f] for p in places]
            pooled.append(max(0.0, max(values)))
    return float(np.dot(pooled, net.out.astype(float)) + net.offset)


def some_texts(n=6):
    buckets, rng = toxicity.Buckets(), random.Random(4)
    return [buckets.of(" ".join(rng.choice("the der le bad worse word stemming stemmed".split()) for _ in range(rng.randint(0, 9)))) for _ in range(n)]


def test_scores_equal_plain_loops():
    net, texts = toxicity.Network.start(9), some_texts(8) + [np.zeros(0, np.int64)]
    want = [slow_logit(net, t.tolist()) for t in texts]
    assert net.logits(texts) == pytest.approx(want, abs=1e-4)
    assert [net.logits([t])[0] for t in texts] == pytest.approx(want, abs=1e-4)
    net.thresholds[:] = [0.5, -1, 2, 0, 1]
    votes = toxicity._votes()
    scores = net.scores(texts, votes)
    for text, logit, got in zip(texts, want, scores):
        counts = [sum(int(votes[b >> 32, i]) for b in text.tolist()) for i in range(4)]
        own = counts.index(max(counts)) if max(counts) else 4
        assert got == pytest.approx(1 / (1 + np.exp(-(logit - net.thresholds[own]))), abs=1e-5)


def test_gradients_equal_differences():
    net, texts = toxicity.Network.start(3), some_texts(5)
    for p in ("embedding", "out"):
        setattr(net, p, getattr(net, p).astype(float))
    rng = np.random.default_rng(5)  # without biases, padding lies on the edge of the rectifier
    net.filters, net.bias = [f.astype(float) for f in net.filters], [rng.normal(0, 0.2, len(b)) for b in net.bias]
    labels, weight = np.array([1.0, 0, 1, 0, 1]), np.array([0.2, 0.1, 0.4, 0.3, 0.2])

    def loss():
        logits = net.logits(texts)
        return float((weight * (np.log1p(np.exp(logits)) - labels * logits)).sum())

    g, rng, step = net.gradients(texts, labels, weight), random.Random(1), 1e-5
    assert not g.embedding[g.rows == 0].any()
    places = [(net.out, (i,), g.out[i]) for i in range(len(net.out))]
    for bank, own, bias, own_bias in zip(net.filters, g.filters, net.bias, g.bias):
        places += [(bank, at, own[at]) for at in (tuple(rng.randrange(n) for n in bank.shape) for _ in range(15))]
        places += [(bias, (i,), own_bias[i]) for i in range(len(bias))]
    rows_ = [i for i, r in enumerate(g.rows.tolist()) if r]
    places += [(net.embedding, (int(g.rows[i]), e), g.embedding[i, e]) for i in rng.sample(rows_, min(6, len(rows_))) for e in range(3)]
    for values, at, got in places:
        before = values[at]
        values[at] = before + step
        above = loss()
        values[at] = before - step
        below = loss()
        values[at] = before
        assert got == pytest.approx((above - below) / (2 * step), abs=2e-5)
    before, net.offset = net.offset, net.offset + step
    above = loss()
    net.offset = before - step
    assert g.offset == pytest.approx((above - loss()) / (2 * step), abs=1e-6)


def test_thresholds_make_the_fewest_mistakes():
    rng = random.Random(12)
    for n in (5, 40, 200):
        net, texts = toxicity.Network.start(n), some_texts(n)
        labels = np.array([float(rng.random() < 0.4) for _ in texts])
        toxicity.calibrate(net, texts, labels)
        logits, language = net.logits(texts), net.language(texts, toxicity._votes())
        mistakes = lambda t, own: sum((logits[i] >= t) != (labels[i] == 1) for i in own)
        for i in range(len(toxicity.LANGUAGES)):
            own = [j for j in range(n) if language[j] == i]
            bad = sum(labels[j] for j in own)
            group = own if min(bad, len(own) - bad) >= 10 else range(n)
            if 0 < sum(labels[j] for j in group) < len(group):
                every = [min(logits) - 1, *(x + 1e-9 for x in logits)]
                assert mistakes(net.thresholds[i], group) == min(mistakes(t, group) for t in every)


# The label model by plain loops


def slow_label_model(votes, rounds=weak.ROUNDS):
    """Expectation maximisation over texts one by one, shares as dictionaries."""
    rules = range(len(votes[0]))
    start = {(c, r, v): weak.STRENGTH * (weak.BAD, weak.GOOD)[c][v] for c in (0, 1) for r in rules for v in range(3)}

    def shares_of(tally):
        out = {}
        for r in rules:
            total = {c: sum(tally[c, r, v] for v in range(3)) for c in (0, 1)}
            bad = {c: tally[c, r, 0] / total[c] for c in (0, 1)}
            if bad[0] < weak.BETTER * bad[1]:  # tie them at the least ratio that is allowed
                tied = (tally[0, r, 0] + tally[1, r, 0]) / (total[1] + weak.BETTER * total[0])
                bad = {0: min(weak.BETTER * tied, 0.9), 1: tied}
            good = {c: tally[c, r, 2] / max(tally[c, r, 1] + tally[c, r, 2], 1e-12) for c in (0, 1)}
            if good[1] < good[0]:
                both = sum(tally[c, r, 2] for c in (0, 1)) / max(sum(tally[c, r, v] for c in (0, 1) for v in (1, 2)), 1e-12)
                good = {0: both, 1: both}
            for c in (0, 1):
                for v, share in enumerate((bad[c], (1 - bad[c]) * (1 - good[c]), (1 - bad[c]) * good[c])):
                    out[c, r, v] = min(max(share, 1e-6), 1)
        return out

    shares, prior = shares_of(start), weak.PRIOR
    for _ in range(rounds):
        tally, total = dict(start), weak.STRENGTH * weak.PRIOR
        for vote in votes:
            likely = [p * np.prod([shares[c, r, vote[r]] for r in rules]) for c, p in ((0, 1 - prior), (1, prior))]
            good = likely[1] / sum(likely)
            total += good
            for r in rules:
                tally[0, r, vote[r]] += 1 - good
                tally[1, r, vote[r]] += good
        shares, prior = shares_of(tally), total / (len(votes) + weak.STRENGTH)
    return prior, shares


def test_label_model_equals_plain_loops(spark):
    rng = random.Random(21)
    for accuracy in (0.9, 0.6):
        truth = [rng.random() < 0.7 for _ in range(250)]
        votes = [[1 if rng.random() < 0.3 else 2 * int(good == (rng.random() < accuracy)) for _ in range(4)] for good in truth]
        prior, shares = slow_label_model(votes, 100)
        counts = Counter(map(tuple, votes))
        model = weak.fit_label_model(np.array(list(counts)), np.array(list(counts.values())))
        assert model.prior == pytest.approx(prior, abs=1e-6)
        for r in range(4):
            assert list(model.weights[r]) == pytest.approx([np.log(shares[1, r, v] / shares[0, r, v]) for v in range(3)], abs=1e-5)
        frame = spark.createDataFrame([list(v) for v in counts], "a int, b int, c int, d int")
        for row in frame.select("*", model.posterior([F.col(c) for c in "abcd"]).alias("p")).collect():
            likely = [p * np.prod([shares[c, r, row[r]] for r in range(4)]) for c, p in ((0, 1 - prior), (1, prior))]
            assert row["p"] == pytest.approx(likely[1] / sum(likely), abs=1e-5)
