"""Language identification: gradients, held-out accuracy, edge cases."""

import numpy as np

from tallymark.llm import language


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    net = language.Network(["a", "b", "c"])
    net.embedding = net.embedding.astype(np.float64)
    net.kernels = [k.astype(np.float64) for k in net.kernels]
    batch = rng.integers(1, 256, (4, language.WINDOW)).astype(np.uint8)
    target = np.array([0, 1, 2, 1])

    def loss():
        return -np.log(net.probabilities(batch)[np.arange(4), target]).mean()

    gradients = net.gradients(batch, target)
    for i, at in [(0, (batch[0, 3], 2)), (1, (1, 3, 4)), (3, (2, 1, 5)), (5, (3, 1)), (6, (2,))]:
        value = net.parameters()[i]
        before = value[at]
        value[at] = before + 1e-4
        up = loss()
        value[at] = before - 1e-4
        down = loss()
        value[at] = before
        assert abs((up - down) / 2e-4 - gradients[i][at]) < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    true = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs).collect()
    assert len(rows) == len(true)
    tested = [r for r in rows if r.held_out]
    assert len(tested) > 200
    assert sum(r.lang_pred == true[r.doc_id] for r in tested) >= 0.97 * len(tested)


def test_edge_cases(spark, documents):
    rows = [(i, "the quick brown fox " * 30, "en") for i in range(40)]
    rows += [(i, "der schnelle braune Fuchs über " * 30, "de") for i in range(40, 80)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !? 456", "de"), (103, "der Fuchs", None)]
    rows += [(104, "über der schnelle " * 20_000, None), (104, "x", None), (None, "the fox", None)]
    docs = documents(rows).withColumnRenamed("source", "lang_pred").withColumnRenamed("n_chars", "score")
    found = {(r.doc_id, i): r for i, r in enumerate(language.identify(docs).collect())}
    assert len(found) == len(rows)
    by_id = {key: r for (key, _), r in found.items()}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (100, 101, 102))
    assert by_id[103].lang_pred == "de" and by_id[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language.identify(documents([])).collect() == []
    only = language.identify(documents([(2, "words", None)])).collect()
    assert only[0].lang_pred == "und"


def test_forward_pass_is_a_plain_convolution():
    rng = np.random.default_rng(2)
    net = language.Network(["a", "b", "c"], seed=3)
    net.bias = rng.normal(0, 1, net.bias.shape)
    net.offset = rng.normal(0, 1, net.offset.shape)
    batch = rng.integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    for row, found in zip(batch, net.probabilities(batch)):
        pooled = []
        for kernel in net.kernels:
            for f in range(language.FILTERS):
                pooled.append(max(
                    sum(float(net.embedding[row[at + k]] @ kernel[k, :, f]) for k in range(len(kernel)))
                    for at in range(language.WINDOW - len(kernel) + 1)
                ))
        hidden = np.maximum(np.array(pooled) + net.bias, 0)
        odds = np.exp(hidden @ net.dense + net.offset)
        assert np.allclose(found, odds / odds.sum(), atol=1e-4)


def test_rows_without_an_id_or_with_one_id_are_learnt_from(spark, documents):
    english = [(None, f"the quick brown fox {i} runs over the lazy dog", "en") for i in range(900)]
    german = [(8, f"der schnelle braune Fuchs {i} über den Hund", "de") for i in range(900)]
    french = [(i, "le renard brun", "fr") for i in range(0, 40)]
    rows = language.sample(documents(english + german + french), 50).collect()
    numbers = {}
    for r in rows:
        numbers.setdefault(r.lang, set()).add(r.number)
    # The bound holds whatever the ids are, and is reached.
    assert {k: len(v) for k, v in numbers.items()} == {"en": 50, "de": 50, "fr": len(numbers["fr"])}
    assert 20 < len(numbers["fr"]) <= 40 and len(rows) <= 150 * (language.WINDOWS_PER_TEXT + 1)


def test_repeated_rows_count_once_in_the_sample(spark, documents):
    rows = [(8, "the same text", "en")] * 500 + [(9, "other words", "en")]
    assert len({r.number for r in language.sample(documents(rows), 50).collect()}) == 2
