"""What the methods find beyond the fixed formats, and what they leave alone."""

import random
import string

from tramline.llm import licenses
from tramline.llm.pii import find_personal_data
from tramline.llm.secrets import find_secrets, redact_secrets


def test_random_tokens_are_found_and_long_words_are_not(spark):
    r = random.Random(3)
    words = ["keit", "lich", "schaft", "nation", "mentale", "rechts", "wirt", "ver", "stand", "ung", "heiten", "bar"]
    plain = ["".join(r.choice(words) for _ in range(r.randint(3, 7))) for _ in range(300)]
    secret = ["".join(r.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(40)]
    rows = [(i, f"see {w} and {v} here") for i, (w, v) in enumerate(zip(plain, plain[::-1], strict=True))]
    rows += [(1000 + i, f"the value is {s} ok") for i, s in enumerate(secret)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {s["match"] for x in find_secrets(docs).collect() for s in x.added}
    assert len(found & set(secret)) >= 36 and not found - set(secret)
    text = {x.doc_id: x.text for x in redact_secrets(docs).collect()}
    assert text[0] == rows[0][1] and sum(text[1000 + i] == "the value is [SECRET] ok" for i in range(40)) >= 36


def test_contexts_of_seeds_find_other_identifiers(spark):
    rows = [(i, f"please call desk +1 (555) 123-45{i:02d} today") for i in range(20)]
    rows += [(50, "please call desk AB-77123 today"), (51, "order part XY-99123 today"), (52, "part 12345678 and part 4567812")]
    got = {x.doc_id: [(s["kind"], s["match"]) for s in x.added]
           for x in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == [("context", "ab-77123")] and not got[51] and not got[52] and not got[0]


def test_found_identifiers_lead_to_further_patterns(spark):
    rows = [(i, f"please call desk +1 (555) 123-45{i:02d} today") for i in range(20)]
    rows += [(100 + i, f"please call desk AB-77{i:03d} today") for i in range(10)]
    rows += [(200 + i, f"with badge no AB-77{i:03d} today") for i in range(10)] + [(300, "with badge no ZQ-55123 today")]
    rows += [(400 + i, f"order part XY-99{i:03d} today") for i in range(10)]
    got = {x.doc_id: [s["match"] for s in x.added]
           for x in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k + i] == [f"ab-77{i:03d}"] for k in (100, 200) for i in range(10)) and got[300] == ["zq-55123"]
    assert not any(got[400 + i] for i in range(10))


def test_licence_wording_without_a_base_phrase(spark):
    rows = [(1, "Redistribution and use in source and binary forms, with or without any modification, are permitted provided "
                "that the following conditions are met: none."),
            (2, "Licensed under CC BY-NC 4.0."), (3, "Redistribution of wealth and binary forms of thought."),
            (4, "released under the mit license")] + [(10 + i, "plain words only here") for i in range(30)]
    got = {r.doc_id: r for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[2].labels, got[3].labels, got[4].labels) == ("bsd", "cc-by-nc", "", "mit")
    assert got[1].base_labels == "" and 0.5 < got[1].score <= 1 and got[3].score == 0 and got[10].labels == ""
