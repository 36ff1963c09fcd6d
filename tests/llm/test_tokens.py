"""Which texts the word memo may take: their white space, against the tokenizer itself."""

from array import array

from editengine.llm import tokens


def test_every_white_space_is_told(monkeypatch):
    for code in [*range(0xD800), *range(0xE000, 0x11000)]:
        for text in (f"a{chr(code)}b", f"a{chr(code)}漢"):
            if chr(code) not in " \n":
                assert tokens._odd_space(text) == (len(text.split()) != 1), hex(code)
    assert not tokens._odd_space("é b\nc") and not tokens._odd_space("漢 b\nc")


def test_odd_white_space_gives_the_tokenizers_ids():
    encoder = tokens.Encoder("word_bpe_49k.json")
    texts = [f"one, two{x}three. Four\nfive é{y}" for x in [*tokens.ODD_SPACES, " ", " ", "　"] for y in ("", "x", "漢")]
    want = [array("I", x.ids).tobytes() for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want == encoder.encode(texts)
