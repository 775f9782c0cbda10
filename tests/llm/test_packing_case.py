import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuswright.llm.packing import Encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("text", [
    "H̱alab", "T̈ W̊ Y̊ J̌", "<|ENDOFTEXT|>x", "a <|StartOfText|> b", "<|endofText|>. C", "<|endoftext|>X",
    "Straße, ÄRGER, H̱ALAB. Plain WORDS, Plain words. İST Kelvin ΟΔΟΣ",
    "Русский ТЕКСТ, éA Éa. It's IT'S x≠y", "",
])
def test_ids_follow_the_tokenizer_in_any_case(text):
    want = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    encoder = Encoder(WORDS)
    for _ in range(2):
        ids, counts = encoder([b"Plain " + text.lower().encode(), text.encode(), "Grün x".encode()])
        assert ids[counts[0] : counts[0] + counts[1]].tolist() == want
