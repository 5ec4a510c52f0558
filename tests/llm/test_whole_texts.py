"""Nothing of a text is left unread: every place of a term, every letter of a word."""

from fathom.llm import pii, toxicity


def test_disclosing_terms_far_from_their_entity(spark):
    far = "filler " * 40
    texts = [f"call Zebulon about bob@x.org today {far}{i} zebulon, Zebulons {far}ZEBULON" for i in range(4)]
    texts += [f"today other words filler about call {i}" for i in range(36)] + ["Zebulon again"]
    frame = spark.createDataFrame([*enumerate(texts), (0, "another text of Zebulon"), (0, texts[0])], "doc_id long, text string")
    clean = [r.text for r in pii.sanitise(frame).collect()]
    assert not any("zebulon" in t.lower().replace("zebulons", "") for t in clean)
    assert sum("[EMAIL]" in t for t in clean) == 5 and {"[NAME] again", "another text of [NAME]"} <= set(clean)
    found = {r.doc_id: r for r in pii.find(frame.filter("doc_id > 0")).collect()}
    assert [texts[1][t.start : t.end] for t in found[1].terms if t.value == "zebulon"] == ["Zebulon", "zebulon", "ZEBULON"]


def judged(spark, bad, good, probes):
    """Scores of ``probes`` by a model of 60 texts with the word ``bad`` and 60 with the words ``good`` in its place."""
    texts = [f"{x} eins {i} zwei" for i in range(60) for x in (bad, good)]
    docs = spark.createDataFrame([*enumerate(texts + probes)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(120)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).filter("doc_id >= 120").orderBy("doc_id").collect()
    return [r.score for r in rows]


def test_words_that_share_a_stem_are_told_apart(spark):
    for bad, good in (("scheisse", "scheinen schenken"), ("сукаблин", "сукно сукровица"), ("éèàçmal", "éèàbon")):
        toxic, *clean = judged(spark, bad, f"{bad[:5]}x {good}", [f"drei {bad} vier", f"drei {good} vier", "drei vier"])
        assert toxic > 0.5 > max(clean)


def test_inflections_share_their_stem(spark):
    toxic, clean = judged(spark, "idiotisch", "freundlich", ["drei idiotinnen vier", "drei freunde vier"])
    assert toxic > 0.5 > clean


def test_scripts_without_spaces_are_read_whole(spark):
    for bad, good in (("大笨蛋", "好朋友"), ("ばかやろう", "ともだちだ"), ("ไอ้โง่", "เพื่อน")):
        around = "今天我们一起去公园" if bad[0] > "ぁ" else "วันนี้เราไปสวน"
        toxic, clean = judged(spark, around + bad + around, around + good + around, [around * 3 + bad + around, around * 3 + good + around])
        assert toxic > 0.5 > clean


def test_tokens_do_not_depend_on_the_slices(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from fathom.llm._text import utf8_buffers

    texts = ["Größe, zwei", None, "", "今天 ab日本", "x" * 90, "tail 😀 “Ende”", " "]
    whole = toxicity._tokens(*utf8_buffers(pa.array(texts)))
    assert whole[2].tolist() == [2, 0, 0, 5, 90, 3, 0]
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 8)
    for one, two in zip(whole, toxicity._tokens(*utf8_buffers(pa.array(texts)))):
        assert np.array_equal(one, two)
