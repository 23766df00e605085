import random
import zlib
from collections import Counter

import pytest

from playmetrics.llm import language_id
from playmetrics.llm.queries import op1_language_id
from tests.llm.frames import AWKWARD, documents, plain


def slow_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    counts = Counter()
    for word in words:
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[i:i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i:i + 3] for i in range(len(padded) - 2))
    return counts


def as_text(number):
    chars = []
    while number:
        chars.append(chr(number & (1 << 21) - 1))
        number >>= 21
    return "".join(reversed(chars))


@pytest.mark.parametrize("text", [*AWKWARD, "Das ist, ein Täst!", "x1y", " a  b "])
@pytest.mark.parametrize("piece", [1 << 20, 5])
def test_grams(monkeypatch, text, piece):
    if piece == 5 and text and len(text) > 1000:
        text = text[:1000]
    monkeypatch.setattr(language_id, "_PIECE", piece)
    grams, counts = language_id.count_grams(text)
    assert dict(zip(map(as_text, grams.tolist()), counts.tolist())) == dict(slow_grams(text))


def number(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def slow_predict(text, profiles, length):
    ranked = lambda counts: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))][:length]
    own = ranked(slow_grams(text))
    if not own:
        return "und", 0.0
    total = {}
    for lang, counts in profiles.items():
        ranks = {g: i for i, g in enumerate(ranked(counts))}
        total[lang] = sum(abs(ranks[g] - i) if g in ranks else length for i, g in enumerate(own))
    best = min(sorted(total), key=total.get)
    return best, 1 - total[best] / (length * len(own))


def test_predictions_against_brute_force(spark):
    rng = random.Random(6)
    alphabets = {"aa": "abcde ", "bb": "defgh ", "cc": "ñéxyz "}
    rows = []
    for i in range(240):
        lang = rng.choice([*alphabets, None])
        text = "".join(rng.choice(alphabets[lang or "aa"]) for _ in range(rng.randint(0, 300)))
        rows.append((i, text, lang, "s"))
    rows += [(300 + i, t, "aa", None) for i, t in enumerate(AWKWARD)] + [(None, "abc", "bb", "s")]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 0
    profiles = {}
    for i, text, lang, _ in rows:
        if not held(i) and lang is not None:
            profiles.setdefault(lang, Counter()).update(slow_grams(text))
    found = language_id.language_id(documents(spark, rows)).collect()
    got = Counter((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in found)
    expected = Counter()
    for i, text, _, _ in rows:
        lang, score = slow_predict(text, profiles, language_id.PROFILE)
        expected[i, held(i), lang, round(score, 9)] += 1
    assert got == expected


def test_the_label_is_not_read_in_prediction(spark):
    docs = [(i, "abc " * 20 if i % 2 else "xyz " * 20, "l1" if i % 2 else "l2", "s") for i in range(50)]
    ranked = language_id.learn(documents(spark, docs).select("doc_id", "text", "lang"))
    swapped = documents(spark, [(i, t, "l2" if lang == "l1" else "l1", s) for i, t, lang, s in docs])
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(swapped, ranked).collect()}
    assert got == {i: lang for i, _, lang, _ in docs}


def test_sample_is_bounded(spark):
    docs = documents(spark, [(i, "ab" if i % 2 else "a" * (i + 1), "x", "s") for i in range(2000)])
    ranked = language_id.learn(docs.select("doc_id", "text", "lang"), sample_docs=10)
    rows = ranked.collect()
    assert {r["lang"] for r in rows} == {"x"} and 0 < len(rows) <= language_id.PROFILE
    assert sorted(r["place"] for r in rows) == list(range(len(rows)))


def test_nothing_to_learn(spark):
    got = language_id.language_id(documents(spark, [(1, "abc", None, "s"), (2, None, "x", "s")])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert language_id.language_id(plain(spark, [])).collect() == []


def many_languages(count):
    """Documents of ``count`` languages, each with words of its own."""
    rng = random.Random(count)
    rows = []
    for k in range(count):
        words = ["".join(rng.choice("abcdefghijklmno") for _ in range(5)) for _ in range(3)]
        rows += [(2 * k + i, " ".join(words), f"l{k}", "s") for i in range(2)]
    return rows


@pytest.mark.parametrize("at_once, turns", [(1, 3), (2, 1), (7, 2), (15, 8), (16, 8)])
def test_languages_may_take_turns(spark, monkeypatch, at_once, turns):
    rows = many_languages(15)
    docs = documents(spark, rows + [(900, "", "l1", "s"), (901, "12", None, "s"), (902, "zzz", None, "s")])
    profiles = language_id.learn(docs.select("doc_id", "text", "lang"))
    whole = sorted(language_id.identify(docs, profiles).collect())
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", at_once)
    monkeypatch.setattr(language_id, "TURNS", turns)
    assert sorted(language_id.identify(docs, profiles).collect()) == whole
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in whole}
    assert all(got[i][0] == lang for i, _, lang, _ in rows)
    # without a shared n-gram the first language in code point order, without letters none
    assert got[900] == got[901] == ("und", 0.0) and got[902] == ("l0", 0.0)


def test_a_language_named_as_the_unknown_one_keeps_its_ties(spark, monkeypatch):
    docs = documents(spark, [(1, "abc", "und", "s"), (2, "abc", "zz", "s"), (3, "abc", "aa", "s")])
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 1)
    profiles = language_id.learn(docs.where("lang != 'aa'").select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language_id.identify(docs, profiles).collect()} == {"und"}


def test_more_languages_than_one_turn_holds(spark):
    rows = many_languages(1100)
    docs = documents(spark, rows)
    profiles = language_id.learn(docs.select("doc_id", "text", "lang"))
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, profiles).collect()}
    assert found == {i: lang for i, _, lang, _ in rows}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    judged = op1_language_id(spark, folder).where("held_out").join(truth, "doc_id").collect()
    assert len(judged) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in judged) / len(judged) >= 0.98
