import random
import zlib
from collections import Counter

from reviewgrain.llm import language_id
from reviewgrain.llm.queries import QUERIES


def test_nearest_profile(spark):
    rows = [("en", "the cat and the dog"), ("en", "the house of the man"), ("de", "der hund und die katze"), ("de", "das haus der frau"), (None, "the the the")]
    profiles = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    model = language_id.Profiles([tuple(r) for r in profiles.collect()], language_id.PROFILE)
    assert model.predict("the dog and the man")[0] == "en" and model.predict("DER Hund, die Frau!")[0] == "de"
    assert model.predict("12 34 !") == model.predict("") == model.predict(None) == ("und", 0.0)
    assert 0 <= model.predict("zzz")[1] <= 1


def test_distance_is_the_sum_of_rank_differences():
    profiles = [("a", "x", 0), ("a", "y", 1), ("b", "y", 0), ("b", " y", 1)]
    model = language_id.Profiles(profiles, 4)
    own = sorted(language_id.grams_of("y"), key=lambda g: zlib.crc32(g.encode()))  # all occur once
    assert sorted(own) == [" y", " y ", "y", "y "]
    want = {}
    for lang in "ab":
        place = {g: p for name, g, p in profiles if name == lang}
        want[lang] = sum(abs(place[g] - i) if g in place else 4 for i, g in enumerate(own))
    best = min("ab", key=want.get)
    assert model.predict("y") == (best, 1 - want[best] / 16)


def test_odd_rows(odd):
    profiles = language_id.learn(odd)
    rows = language_id.predict(odd, profiles).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows if r.doc_id in (1, 2, 6)} == {"und"}
    nothing = language_id.learn(odd.limit(0))
    assert {r.lang_pred for r in language_id.predict(odd, nothing).collect()} == {"und"}
    assert language_id.predict(odd.limit(0), profiles).count() == 0


def test_query_on_documents_kept_out(spark, documents):
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.001").collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == len(truth)
    kept_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in kept_out) >= 0.95 * len(kept_out)


def test_grams_of_whole_texts(monkeypatch):
    rng = random.Random(4)
    for size in (1 << 18, 7):
        monkeypatch.setattr(language_id, "AT_ONCE", size)
        for _ in range(200):
            text = "".join(rng.choices("aBé1_ \n.ßÄ漢𝒳İ", k=rng.randrange(40)))
            want = Counter(g for word in language_id.WORD.findall(text.lower()) for g in language_id.grams_of(word))
            codes, times = language_id.grams(text)
            assert {language_id.gram_text(c): n for c, n in zip(codes.tolist(), times.tolist())} == want
            assert all(language_id.gram_code(language_id.gram_text(c)) == c for c in codes.tolist()) and (codes[1:] > codes[:-1]).all()
