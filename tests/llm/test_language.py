import numpy as np
import pytest

from tidemark.llm import language as L

SAMPLES = {
    "en": "the house of the winter is near the bridge and they are with the children in this town",
    "de": "das haus im winter ist nah an der brücke und sie sind mit den kindern in dieser stadt",
    "es": "la casa del invierno está cerca del puente y ellos están con los niños en esta ciudad",
    "ru": "дом зимой рядом с мостом и они с детьми в этом городе"}


@pytest.fixture(scope="module")
def labelled(spark):
    rows, n = [], 0
    for lang, text in SAMPLES.items():
        words = text.split()
        for k in range(40):
            rows.append((n, " ".join(words[(k + j) % len(words)] for j in range(12)), lang))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def brute_viterbi(scores, ids, penalty):
    best, back = scores[ids[0]].astype(float), []
    for i in ids[1:]:
        top = best.argmax()
        back.append([k if best[k] >= best[top] - penalty else top for k in range(len(best))])
        best = np.array([max(best[k], best[top] - penalty) for k in range(len(best))]) + scores[i]
    path = [int(best.argmax())]
    for b in back[::-1]:
        path.append(b[path[-1]])
    return path[::-1]


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(3)
    scores = rng.normal(size=(50, 4)) * 3
    sizes = np.array([5, 1, 30, 7, 30])
    ids = rng.integers(0, 50, sizes.sum())
    got, at = L.viterbi(scores, ids, sizes, 2.5), 0
    for n in sizes:
        assert got[at:at + n].tolist() == brute_viterbi(scores, ids[at:at + n], 2.5)
        at += n


def test_held_out_accuracy_and_spans(spark, labelled):
    got = L.identify(labelled).join(labelled, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["lang_pred"] == r["lang"] for r in held)
    model = L.learn(labelled)
    mixed = SAMPLES["en"] + " . " + SAMPLES["ru"] + " " + SAMPLES["es"]
    row = L.label(spark.createDataFrame([(mixed,)], "text string"), model).first()
    assert [s["lang"] for s in row["spans"]] == ["en", "ru", "es"]
    sizes = [len(L.words_of(SAMPLES[k])) for k in ("en", "ru", "es")]
    assert [s["words"] for s in row["spans"]] == sizes
    assert row["score"] == pytest.approx(max(sizes) / sum(sizes))


def test_edge_cases(docs, empty, spark, labelled):
    got = {r["doc_id"]: r for r in L.identify(docs).collect()}
    assert got[0]["lang_pred"] == got[1]["lang_pred"] == got[15]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got.values()) and not got[None]["held_out"]
    assert L.identify(docs).count() == docs.count()
    assert L.identify(empty).count() == 0 and L.keep_identified(empty).count() == 0
    out = L.keep_identified(docs)
    assert out.columns == docs.columns and out.where("text IS NULL").count() == 0
    strange = L.label(spark.createDataFrame([("ไทย ภาษา",)], "text string"),
                      L.learn(labelled)).first()
    assert strange["lang_pred"] in SAMPLES and strange["score"] == 0
    unlabelled = L.identify(docs.drop("lang").selectExpr("*", "CAST(NULL AS string) lang"))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_words_are_letters_with_their_marks():
    """Numbers that Unicode counts as word characters are no letters; marks split no word."""
    assert L.words_of("½ ² ٣ x² 12 _ Ⅷ") == ["x"]
    assert L.words_of("हिन्दी ne\u0301e É1a") == ["हिन्दी", "ne\u0301e", "é", "a"]
    assert all("".join(L.words_of(chr(c))) == chr(c).lower() for c in range(0x2000)
               if chr(c).isalpha())


def test_more_languages_than_a_byte_counts(spark):
    """Each of 150 languages has words of its own."""
    rows = [(7 * n + j, " ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26)}{x}" for x in "qwrtz"), f"l{n:03}")
            for n in range(150) for j in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(df).join(df, "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got) and len(got) == 1050


def brute_identify(model, text):
    """(language, score) of one text, word by word in plain Python."""
    words = L.words_of(text)
    if not words:
        return "und", 0.0
    rows, known = [], []
    for w in words:
        used = {r for r in range(len(L.RANGES)) for c in w
                if L.STARTS[r] <= ord(c) < [*L.STARTS[1:], 1 << 21][r]}
        n = range(len(model.languages))
        cand = [k for k in n if all(model.ranges[r, k] for r in used)] or [
            k for k in n if any(model.ranges[r, k] for r in used)]
        sums = {k: sum(float(model.logs[s, k]) for s in L.slots(w)) for k in cand}
        top = max(sums.values(), default=0)
        norm = sum(np.exp(v - top) for v in sums.values())
        known.append(bool(cand))
        rows.append([max(L.FLOOR, sums[k] - top - np.log(norm)) if k in sums
                     else L.FLOOR if cand else 0.0 for k in n])
    path = brute_viterbi(np.array(rows), list(range(len(words))), L.SWITCH)
    votes = [sum(p == k and f for p, f in zip(path, known)) for k in range(len(model.languages))]
    counted = sum(votes)
    best = votes.index(max(votes)) if counted else model.common
    return model.languages[best], votes[best] / max(counted, 1)


def test_identify_against_brute_force(spark, labelled, docs):
    """Candidates, scores, path and votes of every text, not the path alone."""
    model = L.learn(labelled)
    mixed = [" ".join(a.split()[:k] + b.split()[k:]) for a in SAMPLES.values()
             for b in SAMPLES.values() for k in (0, 3, 8, 13)]
    texts = mixed + [t for (t,) in docs.where("length(text) < 4000").select("text").collect()] + [
        None, "", "½ 3", "ไทย", "дом ไทย house", "ñ brücke дом"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.label(df, model).collect()}
    for k, text in enumerate(texts):
        lang, score = brute_identify(model, text)
        assert got[k] == (lang, pytest.approx(score)), text


def test_script_ranges_narrow():
    assert L.script_ranges("abc") == 1
    assert bin(L.script_ranges("дом")).count("1") == 1 and L.script_ranges("дом") != 1
