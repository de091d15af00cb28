"""The frequent words of op9 are counted over all documents; words that no cache has met."""

import public_tokenizers
import pytest

from subsidia.llm import token_counts
from subsidia.llm.pretokens import Pieces


def test_frequent_words_count_every_document(spark):
    docs = spark.createDataFrame([(k, "common word" if k % 2 else "common") for k in range(6000)] + [(6000, "rare " * 7000 + "x" * 40), (6001, None), (6002, "")], "doc_id long, text string")
    assert token_counts.frequent_words(docs) == ["rare", "common", "word"]
    assert token_counts.frequent_words(docs, size=1) == ["rare"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_missed_words_go_to_the_model_alone(monkeypatch, name):
    pieces = Pieces(public_tokenizers.path(name))
    text = "It's THE  day:\t\n\n ÀÉß ÿ naïve 1234 'tis we'll ~|[]{} –— ‘x’ “y” … • «» €£§° supercalifragilisticÖ x" + "".join(map(chr, range(32, 127)))
    words = pieces.cut(text)
    want = [pieces.ids(w) for w in words]
    assert pieces.ids(text) == sum(want, [])
    monkeypatch.setattr(pieces, "ids", None)  # the whole path of the library, asked for each word before
    cache = pieces.cache("ids", list)
    assert len(words) > 30 and [cache[w] for w in words] == want
