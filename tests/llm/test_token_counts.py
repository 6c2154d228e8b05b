"""Token counts against the library itself."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymark.llm.token_counts import Vocabulary, count_tokens, proven_entries
from tallymark.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "",
    "<|endoftext|>",
    "one<|endoftext|>two <|endoftext|><|endof",
    "x" * 5000 + "  \n\n y",
    "it's I'LL we've  \t z\r\n",
    "Élan vital — 東京 ١٢٣ \U0001f600\U0001f600 ñandú ß",
    "word " * 30_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_proven_entries_are_single_tokens_and_others_are_not(library):
    definition = open(FILE, encoding="utf-8").read()
    proven = set(proven_entries(definition))
    assert len(proven) > 49_000
    assert all(expected(library, entry) == 1 for entry in sorted(proven)[::50])
    assert Vocabulary(definition).merged("zqxjk") > 1


def test_edge_cases(spark, documents, library):
    rows = [(i, text) for i, text in enumerate([*TEXTS, None])]
    rows += [(3, TEXTS[3]), (None, "ab")]
    frame = documents(rows).withColumnRenamed("lang", "n_tokens")
    found = sorted((repr(tuple(r)) for r in count_tokens(frame, FILE, 512).collect()))
    wanted = [
        (i, len((t or "").encode()), expected(library, t), expected(library, t) > 512) for i, t in rows
    ]
    assert found == sorted(map(repr, wanted))
    assert count_tokens(documents([]), FILE).collect() == []


def test_query_counts_as_the_library_does(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_token_counts"](spark, folder).collect()
    assert len(rows) == len(texts)
    assert all(r.n_tokens == expected(library, texts[r.doc_id]) for r in rows)
