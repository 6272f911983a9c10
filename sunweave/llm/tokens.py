"""Token counts, and encoders that remember the ids of frequent words.

``token_counts`` is operator 9: batches balanced by bytes go through the library in an Arrow function that returns
lengths only; long texts are cut at safe boundaries first.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated rows each get a row; long
texts are counted whole, cut only where the count stays the same; ill-formed UTF-8 is mended first and counted so; an empty
table gives an empty table; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunweave.llm.arrow import slices, utf8

#: Bytes of text in one call of a library, and those beyond which a text is cut.
CALL_BYTES = 1 << 20
LONG_BYTES = 1 << 18


def default_path(name: str) -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


# --- counts -----------------------------------------------------------------------------------------------------------


def safe_cuts(text: str, most: int) -> list[str]:
    """The text in pieces of about most characters, each but the first starting with a space that follows a non-space.

    No piece of a vocabulary that holds its space marks in front only can span such a place, so that the counts of the
    parts, each encoded without its first space (which the encoder adds itself), sum to the count of the whole.
    """
    out, start = [], 0
    while len(text) - start > most:
        at = regex.compile(r"(?<=[^ ▁]) (?=[^ ▁])").search(text, start + most)
        if not at:
            break
        out.append(text[start : at.start()])
        start = at.start()
    return [*out, text[start:]]


def sentencepiece_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts by the sentencepiece library; long texts are cut where its vocabulary allows that."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    cuttable = not any("▁" in p.lstrip("▁") for p in pieces) and model.encode("a  b", out_type=str) == ["▁a", "▁", "▁b"]

    def counts(texts: list[str]) -> list[int]:
        parts, owner = [], []
        for i, text in enumerate(texts):
            cut = safe_cuts(text, LONG_BYTES) if cuttable and len(text) > LONG_BYTES else [text]
            parts += [cut[0], *(x[1:] for x in cut[1:])]
            owner += [i] * len(cut)
        out = [0] * len(texts)
        for i, ids in zip(owner, model.encode(parts, num_threads=1), strict=True):
            out[i] += len(ids)
        return out

    return counts


def library_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts by the tokenizers library, whole texts."""
    tokenizer = load(path)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, model: str, limit: int = 4096, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row; model: a vocabulary's name or path, .model or .json."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model if os.path.isabs(model) else default_path(model)
        count = sentencepiece_counter(path) if path.endswith(".model") else library_counter(path)
        for part in slices(batches, "text", CALL_BYTES):
            data = utf8(part.column("text"))
            tokens = count([x.decode() for x in data])
            yield pa.RecordBatch.from_pydict(
                {
                    key: part.column("key"),
                    "n_bytes": pa.array([len(x) for x in data], pa.int64()),
                    "n_tokens": pa.array(tokens, pa.int64()),
                    "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
                }
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


# --- ids --------------------------------------------------------------------------------------------------------------


def load(path: str):
    """A tokenizer of the tokenizers library, on one thread, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Latin-1 letters, which no normalisation but that of case changes where nothing but ASCII signs stands beside them.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: ASCII signs but the apostrophe, with which pre-tokenizers begin suffixes.
_SIGNS = r"[!-&(-/:-@\[-`{-~]"
#: What byte-level pre-tokenizers may cut or join elsewhere than before single spaces and around single line feeds.
_IRREGULAR = r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\x00\x01\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# What a definition holds of the two kinds of vocabularies that are known to fall apart by words.
_FORMS: dict[str, dict] = {
    "bytes": {
        "normalizer": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
    },
    "words": {
        "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        "pre_tokenizer": {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
    },
}


def vocabulary_form(path: str) -> tuple[str | None, list[str]]:
    """("bytes", "words" or None, added strings): how texts fall apart, None unless the definition is one that is known.

    Added strings must be looked for in the text as it is, without regard to what stands beside them.
    """
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    added = d.get("added_tokens") or []
    if any(t.get("normalized") or t.get("lstrip") or t.get("rstrip") or t.get("single_word") or not t["content"] for t in added):
        return None, []
    model = {k: v for k, v in d["model"].items() if k not in ("vocab", "merges")}
    has = {"normalizer": d.get("normalizer"), "pre_tokenizer": d.get("pre_tokenizer"), "model": model}
    return next((name for name, form in _FORMS.items() if form == has), None), [t["content"] for t in added]


def _strings(column: pa.Array) -> list[str]:
    """A string column as a list, made at once and not value by value."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _as_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies show each byte as: itself, or the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in shown]
    return {x: chr(x) for x in shown} | {x: chr(256 + i) for i, x in enumerate(hidden)}


class WordMemory:
    """Ids of texts, encoded by words that a bounded memory keeps.

    A batch of texts is cut into words whose ids joined are those of the whole text; texts that can't be cut so, and all
    texts of a vocabulary whose definition isn't known, go through the library whole. Each distinct word of a batch is
    looked up once. A word of Latin letters, and the signs after it, are pieces of the pre-tokenizer, and the library's
    model encodes them as such; words of any other kind go through the whole library. Two generations of words: used ones
    move to the new, the old goes when it's full.
    """

    def __init__(self, path: str, kind: str | None = None, most: int = 200_000):
        self.tokenizer, self.most = load(path), most
        form, added = vocabulary_form(path)
        self.form = form if kind in (None, form) else None
        self.model, self.signs, self.tails = self.tokenizer.model, _as_signs(), {"": b""}
        stop = "|".join(re.escape(x) for x in added)
        self.whole = {"bytes": _IRREGULAR + f"|{stop}" * bool(stop), "words": f"(?i){stop}" if stop else ""}.get(self.form or "", "")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _shown(self, piece: str) -> str:
        return piece.replace(" ", "Ġ") if piece.isascii() else piece.encode().decode("latin-1").translate(self.signs)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of the pre-tokenizer."""
        tokenize, shown = self.model.tokenize, self._shown
        return [array("I", [x.id for x in tokenize(shown(p))]).tobytes() for p in pieces]

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """Words of each text; for byte-level vocabularies \\1 marks those that no space stands before."""
        if self.form == "words":
            return pc.ascii_split_whitespace(pc.ascii_lower(texts))
        return pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise("\x01", texts, ""), "\n", " \n \x01"), " ")

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words as _cut gives them."""
        if self.form == "bytes":
            marked, feed = pc.starts_with(words, "\x01"), pc.equal(words, "\n")
            words = pc.if_else(marked, pc.utf8_ltrim(words, "\x01"), pc.if_else(feed, words, pc.binary_join_element_wise(" ", words, "")))
        parts = pc.extract_regex(words, rf"\A(?P<w> ?{_LETTERS})(?P<t>{_SIGNS}*)\z")
        letters, other = parts.field("w"), parts.is_null()
        if self.form == "words":
            letters = pc.utf8_lower(letters)
        units = pc.if_else(other, words, letters).dictionary_encode()
        tails = pc.if_else(other, "", parts.field("t")).dictionary_encode()
        keys = _strings(units.dictionary)
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        found = list(map(new.get, keys))
        gaps = [i for i, x in enumerate(found) if x is None]
        if gaps:
            there = [old.get(keys[i]) for i in gaps] if old else [None] * len(gaps)
            plain = pc.match_substring_regex(units.dictionary, rf"\A ?{_LETTERS}\z").to_numpy(zero_copy_only=False)[gaps].tolist()
            for way, fits in ((self._pieces, True), (self._library, False)):
                own = [i for i, x, p in zip(gaps, there, plain, strict=True) if x is None and p == fits]
                for i, ids in zip(own, way([keys[i] for i in own]), strict=True):
                    found[i] = ids
            for i, x in zip(gaps, there, strict=True):
                if x is not None:
                    found[i] = x
            new.update(zip([keys[i] for i in gaps], [found[i] for i in gaps], strict=True))
        for t in (every := _strings(tails.dictionary)):
            if t not in self.tails:
                self.tails[t] = self._pieces([t])[0]
        ends = pa.array([self.tails[t] for t in every], pa.large_binary())
        if len(self.tails) > self.most:
            self.tails = {"": b""}
        return pc.binary_join_element_wise(pa.array(found, pa.large_binary()).take(units.indices), ends.take(tails.indices), pa.scalar(b"", pa.large_binary()))

    def encode_column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i of a string column without nulls has ids[bounds[i]:bounds[i + 1]], end_id the last."""
        whole = pc.match_substring_regex(texts, self.whole) if self.whole else pa.array([self.form is None] * len(texts), pa.bool_())
        lists = self._cut(pc.if_else(whole, "", texts) if self.form else pa.array([""] * len(texts)))
        coded = lists.values.dictionary_encode()
        ids = self._ids(coded.dictionary).take(coded.indices) if self.form else pa.array([], pa.large_binary())
        places = np.frombuffer(ids.buffers()[1], "<i8")[: len(ids) + 1] // 4 if len(ids) else np.zeros(1, np.int64)
        flat = np.frombuffer(ids.buffers()[2], "<u4")[: places[-1]] if len(ids) and places[-1] else np.zeros(0, "<u4")
        bounds = places[lists.offsets.to_numpy()] if self.form else np.zeros(len(texts) + 1, np.int64)
        at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(at):
            own = dict(zip(at.tolist(), (np.frombuffer(x, "<u4") for x in self._library(texts.take(pa.array(at)).to_pylist())), strict=True))
            sizes = np.diff(bounds)
            sizes[at] = [len(own[i]) for i in at.tolist()]
            flat = np.concatenate([np.zeros(0, "<u4"), *(own.get(i, flat[a:b]) for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)))])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
        if end_id is not None:
            flat = np.insert(flat, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
        return flat, bounds

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        flat, bounds = self.encode_column(pa.array(texts, pa.binary()).cast(pa.string()))
        return [flat[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_encoders: dict[tuple[str, str | None], WordMemory] = {}


def word_encoder(path: str, kind: str | None = None) -> WordMemory:
    """kind: what the vocabulary's definition is expected to be; of another one, texts go through the library whole.

    A worker keeps the encoder for its next tasks.
    """
    if (path, kind) not in _encoders:
        _encoders[path, kind] = WordMemory(path, kind)
    return _encoders[path, kind]


def forget() -> None:
    """Frees the words that this worker remembers, for work that needs the memory."""
    _encoders.clear()
