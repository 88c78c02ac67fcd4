"""Words that op3 encodes by the joined text of many, against each by itself."""

import public_tokenizers

from lodgeflow.llm import sentencepieces

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["the", "a", "Ünïcode", "漢字", "😀x", "a\nb", "\x00", "<s>", "</s>", "12345", "x" * 200, *[f"w{i}é" for i in range(300)]]


def codec():
    with open(PIECE_BPE, "rb") as file:
        return sentencepieces.Codec(file.read())


def test_joined_words_have_the_ids_of_single_ones():
    made = codec()
    alone = [e.ids for e in made.bare.encode_batch_fast(["▁" + w for w in WORDS], add_special_tokens=False)]
    assert list(made.joined_ids(WORDS)) == alone


def test_words_go_to_the_tokenizer_many_at_a_time():
    """Once each, in texts of up to 64; what they decode to is kept only where it differs."""
    made = codec()
    sent = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return self.inner.encode_batch_fast(texts, **how)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    made.bare = Counting(made.bare)
    text = " ".join(f"word{i}" for i in range(640))
    (ids, back), = made.there_and_back([text])
    assert back == text and made.decode([ids]) == [text]
    assert len(sent) == 10 and not made.back
