"""Token ids of many texts with a public tokenizer of the `tokenizers` library.

Texts repeat their words, and white space only separates in these vocabularies. So each distinct word of a batch is encoded
once, known words come from a bounded cache of the worker, and the ids are gathered with numpy.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from cohortline.llm.common import ranges

#: Words and forms kept by a worker; a full cache is emptied. It only saves time.
CACHED_WORDS, CACHED_FORMS = 1_000_000, 1_000_000
#: A word of Latin letters and the stops after it: normalisation leaves these letters alone, but for capitals.
LATIN = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+"
LETTERS = re.compile("[a-z\u00DF-\u00F6\u00F8-\u012F\u0131-\u024F]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others follow U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


BYTES = byte_letters()


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """ids_of(texts): all ids end to end and the number of ids of each text, as the tokenizer gives them without special tokens.

    A form is what stands between white space. It is one word, or a plain word without its capitals and the stops after it, which are
    tokens of their own; Arrow takes new forms apart, and only their distinct words are looked up one by one."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._empty()

    def _empty(self) -> None:
        self.code: dict[str, int] = {"": 0}
        self.ids, self.ends = array("I"), array("q", [0])
        self.forms, self.form_parts = pa.array([], pa.string()), np.empty((0, 2), np.int64)

    def _learn(self, words: list[str]) -> None:
        """Adds words. Latin letters are one piece for the model; what else there is goes through the whole tokenizer."""
        other = []
        for word in words:
            if LETTERS.fullmatch(word):
                self.code[word] = len(self.ends)
                raw = word if word.isascii() else "".join([BYTES[b] for b in word.encode()])
                self.ids.extend([t.id for t in self.model.tokenize(raw)])
                self.ends.append(len(self.ids))
            else:
                other.append(word)
        for word, got in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self.code[word] = len(self.ends)
            self.ids.extend(got.ids)
            self.ends.append(len(self.ids))

    def _codes(self, words: list[str]) -> np.ndarray:
        """The code of each of some distinct words."""
        new = [w for w in words if w not in self.code]
        for at in range(0, len(new), 20_000):
            self._learn(new[at : at + 20_000])
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def _parts(self, forms: pa.Array) -> np.ndarray:
        """For each form the codes of its word and of its stops."""
        plain = pc.match_substring_regex(forms, f"^{LATIN}[.,]*$")
        words = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(forms, ".,")), forms).dictionary_encode()
        stops = pc.if_else(plain, pc.replace_substring_regex(forms, f"^{LATIN}", ""), "").dictionary_encode()
        listed, ends = words.dictionary.to_pylist(), stops.dictionary.to_pylist()
        known = set(listed)
        codes = self._codes(listed + [e for e in ends if e not in known])  # at once, so that no code is forgotten between
        end_codes = np.fromiter(map(self.code.__getitem__, ends), np.int64, len(ends))
        return np.stack([codes[words.indices.to_numpy()], end_codes[stops.indices.to_numpy()]], axis=1)

    def _known_parts(self, forms: pa.Array) -> np.ndarray:
        """The `_parts` of some distinct forms; only forms that aren't known yet are taken apart."""
        known = pc.index_in(forms, value_set=self.forms.cast(forms.type))
        new = forms.filter(known.is_null())
        if len(self.code) + len(new) > CACHED_WORDS or len(self.forms) + len(new) > CACHED_FORMS:
            self._empty()  # words and forms together: a form's parts are codes of words
            known, new = pa.nulls(len(forms), pa.int32()), forms
        at = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = np.arange(len(new)) + len(self.forms)
        if len(new):
            self.form_parts = np.concatenate([self.form_parts, self._parts(new)])
            self.forms = pa.concat_arrays([self.forms, new.cast(pa.string())])
        return self.form_parts[at]

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        parts = self._known_parts(words.dictionary).ravel()
        ends = np.frombuffer(self.ends, np.int64)
        starts = np.r_[0, ends[:-1]]
        own = ends[parts] - starts[parts]
        word_ids = np.frombuffer(self.ids, np.uint32)[ranges(starts[parts], own)] if len(self.ids) else np.empty(0, np.uint32)
        lengths = own.reshape(-1, 2).sum(axis=1)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(word_ids))
        found = lists.take(words.indices)
        offsets = split.offsets.to_numpy()
        total = found.offsets.to_numpy()[offsets - offsets[0]].astype(np.int64)
        return found.flatten().to_numpy(), np.diff(total)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary."""
    return WordEncoder(path)


def vocabulary_size(spark: SparkSession, path: str) -> int:
    """How many ids a vocabulary has. A task counts them, so that the driver need not hold the vocabulary."""

    def count(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encoder(path).tokenizer.get_vocab_size()], pa.int64())], ["n"])

    return spark.range(1, numPartitions=1).mapInArrow(count, "n long").first()["n"]


def forget() -> None:
    """Free the vocabularies and words that an earlier stage has left in this worker, for a stage that needs the room."""
    encoder.cache_clear()


def encoded(batch_texts: pa.Array, path: str, end_id: int, rows: int = 4000):
    """For each text its ids as uint32, with the end id; works on slices of a batch to bound the memory."""
    enc = encoder(path)
    for at in range(0, len(batch_texts), rows):
        ids, lengths = enc.ids_of(batch_texts.slice(at, rows))
        stop = 0
        for n in lengths.tolist():
            yield np.append(ids[stop : stop + n], np.uint32(end_id))
            stop += n
