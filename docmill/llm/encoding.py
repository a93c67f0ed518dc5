"""Token ids by the ``tokenizers`` library, each distinct word of a batch once.

The vocabulary's pre-tokenizer never joins characters across white space, and its
normalizer never looks across it, so a text's ids are its words' ids in order.
Arrow splits a batch of texts at ASCII white space and numbers its distinct words;
these are encoded once, and the texts' ids are gathered from them as whole arrays.
Words are normalised and cut into pieces here where their characters allow a plain
rule (Latin letters, digits and signs below U+0180: composed already, lower-cased
one by one), and the library's model encodes the distinct pieces in one call.
Other words go through the whole library.  Nothing is kept between batches, and a
batch is cut into slices of ``SLICE_BYTES`` (a longer text is one slice).
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
VOCABULARY = "word_bpe_49k.json"
SLICE_BYTES = 12 << 20

#: The vocabulary's normalizer and pre-tokenizer for which the plain rule holds.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

#: A character beyond the plain rule: controls, white space other than ASCII, and all from U+0180; or the start of a special token.
BEYOND = re.compile("[^\x20-\x7e\xa1-ſ]|<\\|")
#: SPLIT in lower case below U+0180 (lower-casing may add U+0307, which is no letter); a space, which ends a word, is a piece of its own.
PIECE = re.compile(" |'(?:s|t|re|ve|m|ll|d)|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\x200-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-ſ]+")


def _byte_letters() -> str:
    """The letter of each byte in byte-level vocabularies: visible ones stand for themselves, others follow from U+0100; here a space stays one."""
    letters, following = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters.append(chr(b))
        else:
            letters.append(chr(following))
            following += 1
    letters[32] = " "
    return "".join(letters)


BYTE_LETTERS = _byte_letters()


def _piece_model(spec: dict):
    """The model alone, on pieces between spaces, and which ids end a piece; None if the vocabulary follows other rules."""
    from tokenizers import Tokenizer

    split = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    if (spec.get("normalizer") or {}).get("normalizers") != NORMALIZERS or split != [SPLIT, None] or spec["model"].get("end_of_word_suffix") != WORD_END:
        return None
    vocab = spec["model"]["vocab"]
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
    bare = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
    return Tokenizer.from_str(json.dumps(bare)), ends


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Ragged:
    """Lists of ids in one array: list i is ``ids[ends[i] - sizes[i] : ends[i]]``."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes, self.ends = ids, sizes, np.cumsum(sizes)

    def take(self, of: np.ndarray) -> Ragged:
        """The lists ``of``, in that order."""
        sizes = self.sizes[of]
        ends = np.cumsum(sizes)
        shift = self.ends[of] - ends
        return Ragged(self.ids[np.repeat(shift, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes)

    def joined(self, counts: np.ndarray) -> Ragged:
        """Each next ``counts[i]`` lists as one."""
        ends = np.concatenate(([0], self.ends))[np.concatenate(([0], np.cumsum(counts)))]
        return Ragged(self.ids, np.diff(ends))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words (ASCII white space between them; an empty one may occur), the texts' words as places there, words a text."""
    lists = pc.ascii_split_whitespace(texts)
    numbered = lists.flatten().dictionary_encode()
    return numbered.dictionary, numbered.indices.to_numpy(), pc.list_value_length(lists).to_numpy()


def tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words in lower case (A-Z), the texts' words as places there, words a text; no empty words."""
    words, places, counts = split_words(pc.ascii_lower(texts))
    words = words.to_numpy(zero_copy_only=False).tolist()
    if "" in words:  # of a text with white space at its ends
        empty = words.index("")
        keep = places != empty
        of = np.repeat(np.arange(len(counts)), counts)
        counts, places = np.bincount(of[keep], minlength=len(counts)), places[keep]
    return words, places, counts.astype(np.int64)


class WordEncoder:
    """Encodes whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = "<|startoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        self.plain = _piece_model(json.loads(self.tokenizer.to_str()))

    def encode(self, text: bytes) -> bytes:
        """Ids of one text, little-endian unsigned 32-bit."""
        return self.encode_slice(pa.array([text.decode()])).ids.tobytes()

    def encode_slice(self, texts: pa.Array, end_id: int | None = None) -> Ragged:
        """Ids (uint32) of each text of a string array without nulls; ``end_id`` follows each text."""
        words, places, counts = split_words(texts)
        known = self._words(words.to_pylist())
        if end_id is not None:  # as a word after each text
            known = Ragged(np.append(known.ids, np.uint32(end_id)), np.append(known.sizes, 1))
            places = np.insert(places, np.cumsum(counts), len(words))
            counts = counts + 1
        return known.take(places).joined(counts)

    def _words(self, words: list[str]) -> Ragged:
        """Ids of each distinct word."""
        if not self.plain:
            return self._whole(words)
        odd = [i for i, w in enumerate(words) if BEYOND.search(w)] if BEYOND.search(" ".join(words)) else []
        plain = words
        if odd:
            plain = list(words)
            for i in odd:
                plain[i] = ""
        found = self._plain(plain)
        if odd:
            whole = self._whole([words[i] for i in odd])
            of = np.arange(len(words))
            of[odd] = len(words) + np.arange(len(odd))
            found = Ragged(np.concatenate((found.ids, whole.ids)), np.concatenate((found.sizes, whole.sizes))).take(of)
        return found

    def _plain(self, words: list[str]) -> Ragged:
        """Words that follow the plain rule: distinct pieces are encoded by the bare model, then gathered."""
        if not words:
            return Ragged(np.zeros(0, np.uint32), np.zeros(0, np.int64))
        cut = pa.array(PIECE.findall(" ".join(words).lower())).dictionary_encode()
        pieces, places = cut.dictionary.to_pylist(), cut.indices.to_numpy()
        model, ends = self.plain
        space = pieces.index(" ") if len(words) > 1 else -1
        text = " ".join(p for p in pieces if p != " ")
        ids = np.asarray(model.encode_batch_fast([codecs.charmap_decode(text.encode(), "strict", BYTE_LETTERS)[0]], add_special_tokens=False)[0].ids, np.uint32)
        sizes = np.diff(np.flatnonzero(ends[ids]) + 1, prepend=0)
        known = Ragged(ids, np.insert(sizes, space, 0) if space >= 0 else sizes)
        counts = np.diff(np.concatenate(([-1], np.flatnonzero(places == space), [len(places)])))  # pieces a word and the space after it
        counts[-1] -= 1
        return known.take(places).joined(counts)

    def _whole(self, words: list[str], part: int = 5000) -> Ragged:
        """Words by the whole library; many in one call, told apart by a token that none of them holds."""
        if self.mark_id is None or any(self.mark in w for w in words):
            ids = [np.asarray(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) for w in words]
            return Ragged(np.concatenate([np.zeros(0, np.uint32), *ids]), np.fromiter(map(len, ids), np.int64, len(ids)))
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), part):
            own = np.asarray(self.tokenizer.encode(self.mark.join(words[at : at + part]), add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(own == self.mark_id)
            sizes.append(np.diff(np.concatenate(([-1], cuts, [len(own)]))) - 1)
            ids.append(np.delete(own, cuts))
        return Ragged(np.concatenate(ids), np.concatenate(sizes))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each Python worker and vocabulary."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
