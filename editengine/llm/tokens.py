"""Token ids of whole texts by a public tokenizer, with a bounded memo of words."""

from __future__ import annotations

import os
import re
from array import array
from itertools import islice

MEMO_ENTRIES, MEMO_CHARS = 800_000, 40
END_ID = 2


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


# A closing mark between a letter and white space, and one that stands behind something else.
MARK, ODD_MARK = re.compile(r"(?<=[^\W\d_])([.,])(?=[ \n])"), re.compile(r"[\W_][.,][ \n]")


def shared_encoder(name_or_path: str, entries: int | None = None) -> Encoder:
    """The encoder of this Python worker, which keeps it, and the words it remembers, from task to task."""
    if name_or_path not in _SHARED:
        _SHARED[name_or_path] = Encoder(name_or_path)
    _SHARED[name_or_path].entries = entries
    return _SHARED[name_or_path]


_SHARED: dict[str, Encoder] = {}


def _part_marks(text: str) -> str:
    """A space and "\0" before the closing marks that begin a pre-token."""
    if ODD_MARK.search(text):
        return MARK.sub(" \0\\1", text)
    for mark in (". ", ", ", ".\n", ",\n"):
        text = text.replace(mark, " \0" + mark)
    return text


# White space of one byte but the space and the line end.
ODD_SPACES = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def _odd_space(text: str) -> bool:
    """Whether a text whose spaces and line ends all stand between words holds other white space. A search for one
    character is far cheaper than words, but must be made for each; wider texts may hold many more."""
    try:
        text.isascii() or text.encode("latin-1")
    except UnicodeEncodeError:
        return len(text.split()) != text.count(" ") + text.count("\n") + 1
    return any(x in text for x in ODD_SPACES)


def _bytes_as_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


LETTERS = _bytes_as_letters()


def _spell(text: str) -> str:
    return text if text.isascii() and " " not in text else text.encode().decode("latin-1").translate(LETTERS)


class Encoder:
    """Ids of texts as little-endian 32-bit byte strings, those the tokenizer itself gives for them.

    Neither vocabulary has a pre-token that runs from a non-space into white space. Where single
    spaces and line ends are all the white space a text has, its ids are therefore those of its words,
    each with the white space before it, one after the other; words repeat and are remembered. A mark
    behind a letter begins a pre-token too and is looked up apart from its word. Any other text, and one
    that holds an added token's string, is encoded as a whole. In the memo "\0" marks a word without white space before it.
    """

    def __init__(self, name_or_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = name_or_path if os.path.isabs(name_or_path) else tokenizer_path(name_or_path)
        self.tokenizer = Tokenizer.from_file(path)
        # Strings that the tokenizer takes out of a text before anything else.
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.memo: dict[str, bytes] = {}
        self.entries: int | None = None
        # What the model gets for a Latin word behind a space, if it is either of these forms.
        samples = ["the", "The", "WORDS", "a", "reouannd", "Zyxq", "été", "Straße", "ÑANDÚ", "öffnen"]
        forms = (lambda w: _spell(" " + w)), (lambda w: _spell(w.lower()))
        whole = self._encode([" " + w for w in samples])
        self.form = next((f for f in forms if [self._pieces(f(w)) for w in samples] == whole), None)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, form: str) -> bytes:
        return array("I", [x.id for x in self.model.tokenize(form)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        entries = self.entries or MEMO_ENTRIES
        if len(self.memo) > entries:
            self.memo = dict(islice(self.memo.items(), entries // 2))  # what came first is the most frequent
        out: list = [b""] * len(texts)
        whole, held, missing = [], [], set()
        for k, text in enumerate(texts):
            words = _part_marks(text).replace("\n", " \n").split(" ")
            if any(x in text for x in self.added) or "\0" in text or not words[0] or words[0][0] == "\n" or "" in words or "\n" in words or _odd_space(text):
                whole.append(k)
                continue
            words[0] = "\0" + words[0]
            ids = list(map(self.memo.get, words))
            if None in ids:
                gaps = [i for i, x in enumerate(ids) if x is None]
                missing.update([words[i] for i in gaps])
                held.append((k, words, ids, gaps))
            else:
                out[k] = b"".join(ids)
        if missing:
            found = self._words(missing)
            for k, words, ids, gaps in held:
                for i in gaps:
                    ids[i] = found[words[i]]
                out[k] = b"".join(ids)
        for k, ids in zip(whole, self._encode([texts[k] for k in whole]) if whole else (), strict=True):
            out[k] = ids
        return out

    def _words(self, words: set[str]) -> dict[str, bytes]:
        found, rest = {}, []
        for word in words:
            if self.form and word.isalpha() and (word.isascii() or max(word) < "\u0100"):
                found[word] = self._pieces(self.form(word))
            else:
                rest.append(word)
        spelled = [x[1:] if x[0] == "\0" else x if x[0] == "\n" else " " + x for x in rest]
        found.update(zip(rest, self._encode(spelled), strict=True))
        self.memo.update((w, x) for w, x in found.items() if len(w) <= MEMO_CHARS)
        return found
