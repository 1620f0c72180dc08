"""Language identification of more languages than 200."""

from telemetra.llm import langid


def test_all_languages_are_learnt(spark):
    names = [f"l{i:03d}" for i in range(230)]
    text = lambda i: " ".join(chr(0x4E00 + 8 * i + j) * 2 for j in range(8))
    docs = spark.createDataFrame([(2 * i + j, text(i), name) for i, name in enumerate(names) for j in range(2)], "doc_id LONG, text STRING, lang STRING")
    model = langid.train(docs)
    assert model.languages == names
    found = [model.predict(text(i))[0] for i in range(len(names))]
    assert found[200:] == names[200:] and found == names
