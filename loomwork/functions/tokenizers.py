"""Tokenizers as Column expressions.

A tokenizer turns a text Column into an id-array Column. The two built-in ones run in the
JVM; ``PandasTokenizer`` wraps any ``list[str] -> list[list[int]]`` function for users who bring
their own vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions import arrays
from loomwork.functions.templates import ChatTemplate, get_template

# Fixed value: the end token of a tokenizer that comes without one.
DEFAULT_EOS = "<|endoftext|>"


@dataclass(frozen=True)
class Tokenizer:
    """Base: special tokens and the contract. ``specials`` maps a token to its id."""

    bos: str | None = "<s>"
    eos: str | None = "</s>"
    pad: str | None = None
    specials: dict[str, int] = field(default_factory=dict)

    # First id for special tokens the vocabulary does not know.
    base: int = 0
    # True when the first n ids of a text depend on its first n units only, so a cut may happen
    # on the text before it is encoded.
    cuts_text: bool = False
    # True when the ids of joined texts are the joined ids, so literal pieces become constants.
    joins: bool = False

    def for_template(self, template: str | ChatTemplate) -> "Tokenizer":
        """A copy that has an end token, a pad token and an id for each special token in use."""
        eos = self.eos or DEFAULT_EOS
        pad = self.pad or eos
        specials = dict(self.specials)
        wanted = [t for t in (self.bos, eos, pad) if t] + get_template(template).special_tokens()
        for token in wanted:
            if token not in specials:
                specials[token] = max([self.base - 1, *specials.values()]) + 1
        return replace(self, eos=eos, pad=pad, specials=specials)

    def special_id(self, token: str) -> int:
        return self.specials[token]

    @property
    def bos_ids(self) -> list[int]:
        return [self.specials[self.bos]] if self.bos else []

    @property
    def eos_id(self) -> int:
        if not self.eos:
            raise ValueError("an end token is required")
        return self.specials[self.eos]

    @property
    def pad_id(self) -> int:
        return self.specials[self.pad] if self.pad else self.eos_id

    def encode(self, text: Column) -> Column:
        raise NotImplementedError

    def literal_ids(self, text: str) -> list[int]:
        """Ids of a literal, known on the driver."""
        raise NotImplementedError

    def constant(self, ids: list[int]) -> Column:
        """Known ids, special ones and masks, in the form ``encode`` gives ids."""
        return arrays.literal(ids)

    def one(self, i: int) -> Column:
        """One known id in that form."""
        return F.lit(i)

    def literal(self, text: str) -> Column:
        return self.constant(self.literal_ids(text))

    def length(self, text: Column) -> Column:
        return F.size(self.encode(text))

    def head(self, text: Column, n: int) -> Column:
        """A text whose ids start with the first ``n`` ids of ``text``."""
        return text

    def decode(self, ids: Column, skip_special: bool = False) -> Column:
        raise NotImplementedError

    def special_text(self, x: Column, skip: bool) -> Column:
        """Text of a special id; empty when specials are skipped or the id is unknown."""
        out = F.lit("")
        if not skip:
            for token, i in self.specials.items():
                out = F.when(x == i, F.lit(token)).otherwise(out)
        return out


@dataclass(frozen=True)
class CodepointTokenizer(Tokenizer):
    """One id per character, its code point; special tokens start above Unicode."""

    base: int = 0x110000
    cuts_text: bool = True
    joins: bool = True

    def literal_ids(self, text: str) -> list[int]:
        return [ord(c) for c in text]

    def encode(self, text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<int>")).otherwise(
            F.transform(F.split(text, ""), lambda c: F.ascii(c)))

    def length(self, text: Column) -> Column:
        return F.char_length(text)

    def head(self, text: Column, n: int) -> Column:
        return F.substr(text, F.lit(1), F.lit(n))

    def decode(self, ids: Column, skip_special: bool = False) -> Column:
        # chr() stops at 255, so a code point becomes text through its UTF-32 bytes.
        def char(x: Column) -> Column:
            return F.decode(F.unhex(F.lpad(F.hex(x), 8, "0")), "UTF-32")
        return F.array_join(F.transform(
            ids, lambda x: F.when(x < self.base, char(x)).otherwise(self.special_text(x, skip_special))), "")


@dataclass(frozen=True)
class ByteTokenizer(Tokenizer):
    """One id per UTF-8 byte; special tokens start at 256."""

    base: int = 256
    cuts_text: bool = True
    joins: bool = True

    def literal_ids(self, text: str) -> list[int]:
        return list(text.encode("utf-8"))

    def encode(self, text: Column) -> Column:
        # Read as Latin-1, byte n is code point n. ``head`` may hand over bytes already.
        chars = F.decode(text.cast("binary"), "ISO-8859-1")
        return F.when(F.octet_length(text) == 0, F.array().cast("array<int>")).otherwise(
            F.transform(F.split(chars, ""), lambda c: F.ascii(c)))

    def length(self, text: Column) -> Column:
        return F.octet_length(text)

    def head(self, text: Column, n: int) -> Column:
        return F.substr(text.cast("binary"), F.lit(1), F.lit(n))

    def decode(self, ids: Column, skip_special: bool = False) -> Column:
        def piece(x: Column) -> Column:
            return F.when(x < self.base, F.lpad(F.hex(x), 2, "0")).otherwise(
                F.hex(F.encode(self.special_text(x, skip_special), "UTF-8")))
        return F.try_validate_utf8(F.unhex(F.array_join(F.transform(ids, piece), "")).cast("string"))


Codec = tuple[Callable[[list[str]], list[list[int]]], Callable[[list[list[int]]], list[str]]]


@lru_cache(maxsize=None)
def _codec_udfs(load: Callable[[], Codec], hidden: frozenset[int]):
    """Encode and decode functions over Arrow batches; ``load`` runs once per Python worker."""
    loaded: list[Codec] = []

    def codec() -> Codec:
        if not loaded:
            loaded.append(load())
        return loaded[0]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode_batch(texts: pd.Series) -> pd.Series:
        return pd.Series(codec()[0](texts.tolist()))

    @F.pandas_udf(T.StringType())
    def decode_batch(rows: pd.Series) -> pd.Series:
        return pd.Series(codec()[1]([[i for i in row if i not in hidden] for row in rows]))

    return encode_batch, decode_batch


@lru_cache(maxsize=None)
def _driver_codec(load: Callable[[], Codec]) -> Codec:
    return load()


@dataclass(frozen=True)
class PandasTokenizer(Tokenizer):
    """Any tokenizer with a list-in, list-out encoder, run in Arrow batches.

    ``load`` returns ``(encode, decode)``: ``encode`` maps a list of texts to a list of id lists,
    ``decode`` a list of id lists to texts.
    """

    load: Callable[[], Codec] | None = None

    def literal_ids(self, text: str) -> list[int]:
        return list(_driver_codec(self.load)[0]([text])[0])

    def encode(self, text: Column) -> Column:
        return _codec_udfs(self.load, frozenset())[0](text)

    def decode(self, ids: Column, skip_special: bool = False) -> Column:
        hidden = frozenset(self.specials.values()) if skip_special else frozenset()
        return _codec_udfs(self.load, hidden)[1](ids)


TOKENIZERS: dict[str, Tokenizer] = {
    "codepoint": CodepointTokenizer(),
    "utf8_bytes": ByteTokenizer(),
}


def register_tokenizer(name: str, tokenizer: Tokenizer) -> None:
    TOKENIZERS[name] = tokenizer


def get_tokenizer(tokenizer: str | Tokenizer, template: str | ChatTemplate | None = None) -> Tokenizer:
    found = TOKENIZERS[tokenizer] if isinstance(tokenizer, str) else tokenizer
    return found.for_template(template) if template is not None else found
