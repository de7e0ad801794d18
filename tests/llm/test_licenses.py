from fractions import Fraction

from tagloom.llm import licenses


def scan(spark, texts, **kinds):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(df, **kinds).collect()}


def test_phrases_and_blocks(spark):
    got = scan(
        spark,
        [
            "Under the MIT License. under-the (mit) license! the mit license under",
            "licensed under the Apache License, Version 2.0 of it",
            "License version 2 apache the under licensed 0",  # the words in another order
            "licensed under the apache license thing version 2",  # seven of eight
            "apache license version",
            None,
            "",
        ],
    )
    told = {i: [(b.label, b.start, b.end, round(b.share, 3), b.phrase) for b in r.blocks] for i, r in got.items()}
    assert [x for x in told[0] if x[4]] == [("mit", 0, 4, 1.0, True), ("mit", 4, 8, 1.0, True)]
    assert ("apache-2", 0, 8, 1.0, False) in [(a, b, min(c, 8), d, e) for a, b, c, d, e in told[1]]
    assert ("apache-2", 3, 7, 1.0, True) in told[1]
    assert [x[0] for x in told[2]] == ["apache-2"] and not told[2][0][4]
    assert told[3] and not any(x[4] for x in told[3])
    assert told[4] == told[5] == told[6] == [] and got[5].n_words == 0


def test_odd_rows(odd, empty):
    assert licenses.license_digest(odd).count() == odd.count()
    assert licenses.license_digest(empty).count() == 0


def test_threshold_of_one(spark):
    got = scan(spark, ["a b c d e", "a b x c d e"], phrases={"q r": "z"}, templates={"e d c b a": "t"}, threshold=Fraction(1))
    assert [b.share for b in got[0].blocks] == [1.0] and got[1].blocks == []
