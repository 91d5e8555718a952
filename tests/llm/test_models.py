"""Learned operators on held-out rows; surrogates, reputation and the pipeline by their rules."""

from __future__ import annotations

import re

import corpus_pipeline
import numpy as np
from objsync.llm import host_reputation, language_codes, pii_surrogates, toxic_spans
from objsync.llm.queries import URL_RULES
from objsync.llm.shared import table

SF = "/root/testdata/sf0.01"


def test_languages_held_out(spark, empty):
    documents = table(spark, SF, "documents")
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = language_codes.identify_languages(documents).where("held_out").collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held) > 0
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 %", None), (3, "abc", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_codes.identify_languages(odd).collect()} == {"und"}
    assert language_codes.identify_languages(documents.where("false")).collect() == []


def test_toxic_held_out(spark):
    documents, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    tagger = toxic_spans.fit(toxic_spans.labelled_texts(documents, labels))
    scored = toxic_spans.score_documents(documents, tagger)
    held = scored.where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert sum(toxic) >= 0.8 * len(toxic) > 0
    assert sum(clean) <= 0.02 * len(clean)
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.predicted for r in toxic_spans.score_documents(odd, tagger).collect()] == [0, 0]


def _prose(rng, n):
    return [f"w{i}x" for i in rng.integers(0, 4000, n)]


def test_dense_toxic_copies_are_learned(spark):
    rng = np.random.default_rng(0)
    vile = [f"vile{chr(97 + i % 26)}{i}" for i in range(40)]
    copies = []
    for i in range(60):  # edited copies of one dense text
        words = list(vile)
        words[i % 40] = f"w{i}x"
        copies.append((" ".join(words), 1))
    clean = [(" ".join(_prose(rng, 60)), 0) for _ in range(300)]
    tagger = toxic_spans.fit(spark.createDataFrame(copies + clean, "text string, toxic int"))
    held = spark.createDataFrame([(1, " ".join(vile)), (2, clean[0][0])], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxic_spans.score_documents(held, tagger).collect()} == {1: 1, 2: 0}


def test_toxic_words_late_and_strays_in_long_texts(spark):
    rng = np.random.default_rng(1)
    vile = [f"vile{i}" for i in range(12)]
    late = [(" ".join([*_prose(rng, 3200), *rng.permutation(vile)[:10]]), 1) for _ in range(60)]
    clean = [(" ".join(_prose(rng, 600)), 0) for _ in range(700)]
    clean[:6] = [(t + f" {vile[i]}", 0) for i, (t, _) in enumerate(clean[:6])]  # a stray one each, 1 in 70,000 words
    tagger = toxic_spans.fit(spark.createDataFrame(late + clean, "text string, toxic int"))
    strays = _prose(rng, 1_200_000)
    for i in range(17):
        strays[70_000 * i] = vile[i % 12]
    rows = [(1, late[0][0]), (2, clean[10][0]), (3, " ".join(strays)), (4, " ".join(_prose(rng, 100) + vile[:10]))]
    got = toxic_spans.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), tagger).collect()
    assert {r.doc_id: r.predicted for r in got} == {1: 1, 2: 0, 3: 0, 4: 1}


def test_surrogates(spark):
    rows = [
        (1, "Frau Müller wrote A.b@Ex.org and a.b@ex.org, +1 (988) 555-2485"),
        (2, "Mr. Bob and frau Müller 4111 1111 1111 1111 or 4111111111111111 at 10.0.0.1."),
        (3, None),
        (4, "nothing here"),
        (4, "nothing here"),
    ]
    got = pii_surrogates.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    texts = {r.doc_id: r.text for r in got}
    assert texts[3] is None and texts[4] == "nothing here" and len(got) == 5
    a, b = re.findall(r"\S+@\S+\.org", texts[1])
    assert a.lower() == b and b != "a.b@ex.org" and a[0].isupper()
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}$", texts[1]) and "988) 555-2485" not in texts[1]
    spaced, plain = re.search(r"(\d{4} \d{4} \d{4} \d{4}) or (\d{16})", texts[2]).groups()
    assert spaced.replace(" ", "") == plain != "4111111111111111"
    digits = [int(c) for c in plain[::-1]]
    assert (sum(digits[::2]) + sum(d * 2 - 9 * (d > 4) for d in digits[1::2])) % 10 == 0


def test_surrogates_of_general_forms(spark):
    phones = ["(555) 123-4567", "555-123-4567", "+49 30 1234567", "030/1234567", "01 23 45 67 89", "555-1234", "5551234567"]
    phones += ["+1 555 123 4567", "+44 (0)20 7946 0958", "1-555-123-4567"]
    cards = ["378282246310005", "3782 822463 10005", "30569309025904", "4222222222222", "6304 0000 0000 0000 000"]
    kept = ["2024-01-15 10:30", "01.02.2024", "1914-1918", "3.14159265", "1 000 000", "v12.3", "378282246310006"]
    rows = [(i, f"call {p} now") for i, p in enumerate(phones)]
    rows += [(100 + i, f"paid {c}, then") for i, c in enumerate(cards)]
    rows += [(200 + i, f"see {k} there") for i, k in enumerate(kept)]
    rows += [(300, "+1 (826) 555-4081 190.137.223.204 and 2353820953013749 4550997810720808")]
    got = pii_surrogates.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    texts, before = {r.doc_id: r for r in got}, dict(rows)
    for i in range(len(phones)):
        assert texts[i].n_phone == 1 and texts[i].text != before[i], phones[i]
        assert re.sub(r"\d", "0", texts[i].text) == re.sub(r"\d", "0", before[i])
    for i in range(100, 100 + len(cards)):
        assert texts[i].n_card == 1 and texts[i].text != before[i], before[i]
        digits = [int(c) for c in re.sub(r"\D", "", texts[i].text)[::-1]]
        assert (sum(digits[::2]) + sum(d * 2 - 9 * (d > 4) for d in digits[1::2])) % 10 == 0
    assert [texts[i].text for i in range(200, 200 + len(kept))] == [before[i] for i in range(200, 200 + len(kept))]
    assert (texts[300].n_phone, texts[300].n_ip, texts[300].n_card) == (1, 1, 2)
    same = [re.sub(r"\D", "", texts[i].text)[-10:] for i in (0, 1, 6, 7, 9)]
    assert len(set(same)) == 1 and texts[2].text.startswith("call +49 ")


def test_surrogates_of_whole_names_and_mentions(spark):
    rows = [
        (1, "Mr. John Smith met Smith's son. John left; SMITH and John Smith stayed. A smith works."),
        (2, "Frau Mueller-Schmidt and Herr Dr. von Goethe; Schmidt spoke to Goethe."),
        (3, "Mr. O'Brien, Mrs. Mary J. McDonald-Lee. O'Brien and McDonald."),
        (4, "Smith and Schmidt are not titled here"),
    ]
    got = pii_surrogates.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    by_id = {r.doc_id: r for r in got}
    john, smith = re.match(r"Mr\. (\w+) (\w+) met", by_id[1].text).groups()
    assert by_id[1].text == (
        f"Mr. {john} {smith} met {smith}'s son. {john} left; {smith.upper()} and {john} {smith} stayed. A smith works."
    )
    assert not {john, smith} & {"John", "Smith"} and by_id[1].n_name_he == 5
    left, right, goethe = re.match(r"Frau (\w+)-(\w+) and Herr Dr\. von (\w+);", by_id[2].text).groups()
    assert by_id[2].text.endswith(f"; {right} spoke to {goethe}.") and left != "Mueller" and goethe != "Goethe"
    assert not re.search("Brien|Mary|McDonald|Lee", by_id[3].text) and by_id[3].n_name_she == 2
    assert re.match(r"Mr\. (\w+), Mrs\. \w+ [A-Z]\. (\w+)-\w+\. \1 and \2\.$", by_id[3].text)
    assert by_id[4].text == rows[3][1]


def test_reputation(spark):
    urls = [
        "http://a.net/x", "https://M.Example.net/en/1?q", "http://example.com/de/#f", "http://x.org/fr/", "no url",
        None, "http://bad.io?x", "http://good.io/",
    ]
    pages = [(i, u) for i, u in enumerate(urls)] + [(100 + i, "http://bad.io/") for i in range(40)]
    pages += [(200 + i, "http://good.io/") for i in range(40)]
    labels = [(100 + i, 0, 0) for i in range(40)] + [(200 + i, 1, 0) for i in range(40)]
    got = host_reputation.judge_pages(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        URL_RULES,
    )
    by_id = {r.page_id: tuple(r)[1:] for r in got.where("page_id < 100").collect()}
    assert by_id[0] == ("a.net", "/x", "net/", "block")
    assert by_id[1] == ("m.example.net", "/en/1", "example.net/en/", "allow")
    assert by_id[2] == ("example.com", "/de/", "example.com/de/", "block")
    assert by_id[3] == ("x.org", "/fr/", "org/fr/", "allow")
    assert by_id[4][:3] == by_id[5][:3] == ("", "", None)
    assert by_id[6] == ("bad.io", "", None, "block") and by_id[7] == ("good.io", "/", None, "allow")


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
    texts = [r.text or "" for r in docs.select("text").collect()]
    assert 0 < len(texts) <= 1000 and not any(re.search(r"[0-9a-f]{32}", t) for t in texts)


def test_pipeline_ends_in_token_ids(spark):
    docs = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
    packed = corpus_pipeline.packing_stage(spark, docs, SF)
    whole = set(packed.columns) - set(corpus_pipeline.packing.pack_documents(docs, corpus_pipeline.tokenizer_path()).columns)
    assert len(whole) == 1
    (ids,) = whole
    assert [len(r[ids]) == r.length > 0 for r in packed.collect()] == [True, True]


def test_surrogates_come_to_an_end(spark):
    """Forms without anything to draw, and forms whose surrogates are all originals."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = " ".join(f"{a}@{b}.de" for a in letters for b in letters)
    phones = " ; ".join(f"{i:03d}-{j:04d}" for i in (555, 556) for j in range(0, 10_000, 7))
    docs = spark.createDataFrame(
        [(1, "see _@-.com now"), (2, mails), (3, phones), (4, None)], "doc_id long, text string"
    )
    got = {r["doc_id"]: r for r in pii_surrogates.replace_entities(docs, "key").collect()}
    assert "_@-.com" not in got[1]["text"] and got[1]["n_email"] == 1 and got[4]["text"] is None
    for i, old, cut in ((2, mails, " "), (3, phones, " ; ")):
        new = got[i]["text"].split(cut)
        assert len(new) == len(set(new)) == len(old.split(cut)) and not set(new) & set(old.split(cut))


def test_languages_keep_a_quota_whatever_is_repeated(spark):
    words = {x: [f"{x}{i}wort" for i in range(40)] for x in "abcdefg"}
    rows = [(i, " ".join(words["abcdef"[i % 6]][(i * 7 + j) % 40] for j in range(12)), "abcdef"[i % 6]) for i in range(240)]
    rows += [(1000 + i, " ".join(words["g"][:12]), "g") for i in range(200)] + [(5000, "x " * 400_000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language_codes.fit(docs, 70)
    assert sorted(codes.languages) == list("abcdefg")


def test_one_row_of_each_group_stays_by_row(spark):
    text = "the quick brown fox jumps over the lazy dog near the old river bank at noon today"
    rows = [(1, text), (1, "another clean text of the same id"), (2, text), (2, text), (None, text), (None, None)]
    rows += [(7, "said twice by one and the same"), (7, "said twice by one and the same"), (8, ""), (8, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string")
    got = sorted((r["text"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=repr)
    assert got == sorted(["", "", "another clean text of the same id", None, "said twice by one and the same", text], key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.where("false"), SF).collect() == []
