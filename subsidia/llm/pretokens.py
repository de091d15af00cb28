"""Pre-token splitting with per-worker caches, exact with regard to the tokenizers library.

The library spends nearly all of its time on merging the same words again and again. The known vocabularies cut a text
into pre-tokens first and encode each of them on its own, so a text's ids are those of its pre-tokens in order.
``Pieces`` cuts texts made of plainly classified characters itself and asks the library only for pre-tokens that
the worker has not met. Any text with other characters, or with a special string, goes to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# Characters whose class, lower case and normal form are the same in every Unicode version: ASCII without control
# characters, the Latin-1 letters and a few marks of printing.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_UNSAFE = re.compile(rf"[^\t-\r -~{_LETTERS}–—‘’“”…•«»€£§°]")

# The two settings of normalizer and pre-tokenizer whose splitting is known here, as vocabulary files spell them.
_BYTE_SPEC = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
_WORD_SPEC = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)

#: Of each known setting: how safe characters split, and whether they are lower-cased first.
_KNOWN = (
    (_BYTE_SPEC, re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"), False),
    (_WORD_SPEC, re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+"), True),
)

#: Entries of a generation of a worker's cache, unless an operator asks for more; it keeps two, with about 200 bytes an entry, so 40 MB.
CACHE_ENTRIES = 100_000
#: For a query whose work is nearly all encoding: 5.2 % of pre-tokens miss, in place of 9.4 %.
MANY_ENTRIES = 250_000
#: Longer pre-tokens are encoded each time.
CACHED_CHARS = 64

_loaded: dict[str, "Pieces"] = {}


class _Spelled(dict):
    """Characters as byte-level vocabularies spell them: a letter for each byte of UTF-8, itself where it is visible in Latin-1."""

    def __missing__(self, code: int) -> str:
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in visible]
        self[code] = "".join(chr(b if b in visible else 256 + hidden.index(b)) for b in chr(code).encode())
        return self[code]


_spelled = _Spelled()


class Pieces:
    """A vocabulary: a ``.json`` of the tokenizers library or a ``.model`` of sentencepiece.

    Pre-tokens are cut here only if the file has one of the known settings, word for word, and no special string that is
    looked for after normalization. Any other vocabulary gets every text whole.
    """

    def __init__(self, path: str):
        self.caches: dict[str, dict] = {}
        self.split, self.lower = None, False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.ids, self.vocab_size = model.encode, model.vocab_size()
            return
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.ids = lambda text: library.encode(text, add_special_tokens=False).ids
        self.vocab_size = library.get_vocab_size()
        self.model = library.model
        added = spec.get("added_tokens") or []
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added) or r"(?!)")
        for known, split, lower in _KNOWN:
            if known == (spec.get("normalizer"), spec.get("pre_tokenizer")) and not any(t["normalized"] for t in added):
                self.split, self.lower = split.findall, lower

    @staticmethod
    def of(path: str) -> "Pieces":
        """The worker's copy; made once per process."""
        if path not in _loaded:
            _loaded[path] = Pieces(path)
        return _loaded[path]

    def cut(self, text: str) -> list[str] | None:
        """The pre-tokens, or None if the library has to see the whole text."""
        if self.split is None or _UNSAFE.search(text) or self.special.search(text):
            return None
        return self.split(text.lower() if self.lower else text)

    def piece_ids(self, piece: str) -> list[int]:
        """The ids of a pre-token of ``cut``: normalized and cut already, so the library's model alone gives them, in less time."""
        return [t.id for t in self.model.tokenize(piece.translate(_spelled))]

    def cache(self, name: str, value: Callable[[list[int]], object], entries: int = CACHE_ENTRIES) -> dict:
        """A dict from pre-token to ``value(ids)`` that fills itself; to be asked for again now and then, which keeps its bound."""
        if name not in self.caches:
            self.caches[name] = _Filling(lambda piece: value(self.piece_ids(piece)))
        if len(self.caches[name]) > entries:
            self.caches[name].age()
        return self.caches[name]


class _Filling(dict):
    """Two generations: a full one becomes the old one, from which what is met again moves back; so frequent entries stay."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def age(self):
        self.old = {}  # gone before the new one is made
        self.old = dict(self)
        self.clear()

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= CACHED_CHARS:
            self[key] = out
        return out
