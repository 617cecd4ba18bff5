"""What Python workers keep between tasks."""

import weakref

import public_tokenizers

from loomcast.llm import near_dedup, packing, token_store


def test_a_table_stays_for_its_stage_and_goes_with_the_next():
    path = public_tokenizers.path("word_bpe_49k.json")
    kept = weakref.ref(packing.worker_tokenizer(path))
    assert packing.worker_tokenizer(path) is kept()
    assert list(near_dedup._texts(iter(()), 0, 5)) == [] and kept() is None


def test_one_table_at_a_time():
    kept = weakref.ref(packing.worker_tokenizer(public_tokenizers.path("word_bpe_49k.json")))
    words = token_store._worker_words(public_tokenizers.path("byte_bpe_50k.json"))
    assert kept() is None and token_store._worker_words(public_tokenizers.path("byte_bpe_50k.json")) is words
