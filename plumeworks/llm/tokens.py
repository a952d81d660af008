"""Token ids of whole texts, by a public tokenizer, as little-endian 32-bit integers."""

import re
from functools import lru_cache
from string import punctuation

import numpy as np

#: The tokenizer file, the id that ends each document, texts encoded at once, and words remembered by a Python worker (some 200 bytes each).
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BATCH = 512
WORDS_KEPT = 500_000
#: A space or line break between two white-space characters may share a token with them, so such texts are encoded in one go.
_JOINED = re.compile(r"\s[ \n](?:\s|\Z)")
#: In a row of pieces: one that has nothing, or more white space, behind the space or line break that it starts with.
_ODD = re.compile(r" (?:[^\S\n]|\n\s|\n?\Z)")
#: Letters beyond ASCII that every version of Unicode in use has.
_LETTERS = re.compile("[\n\u0080-\u07ff\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3A-Za-z]+")
#: Byte-level BPE writes a printable byte of Latin-1 as that character and the others, in order, as those from U+0100 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_PUNCTUATION = frozenset(punctuation)
_known: dict[str, bytes] = {}
_before: dict[str, bytes] = {}
_endings: dict[str, bytes] = {}


@lru_cache(2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@lru_cache(2)
def _splits_at_spaces(path: str) -> bool:
    """Whether the tokenizer is byte-level BPE that starts a new word at a space after a letter, without normalising."""
    t = tokenizer(path)
    return t.normalizer is None and t.post_processor is None and re.fullmatch(
        r"ByteLevel\(add_prefix_space=False, trim_offsets=\w+, use_regex=True\)", str(t.pre_tokenizer)) is not None


def forget() -> None:
    """Drops the words a worker remembers, for other work that it is reused for."""
    for words in (_known, _before, _endings):
        words.clear()


@lru_cache(2)
def _bare(path: str):
    """The model alone, for words that are already cut and written in its alphabet, and the bytes each id stands for."""
    from tokenizers import Tokenizer

    t = Tokenizer(tokenizer(path).model)
    sizes = np.zeros(t.get_vocab_size(), np.int64)
    for token, k in t.get_vocab().items():
        sizes[k] = len(token)
    return t, sizes


def _ids(encoding) -> bytes:
    return np.array(encoding.ids, "<u4").tobytes()


def _whole(texts: list[str], path: str) -> list[bytes]:
    return list(map(_ids, tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)))


def _written(word: str) -> str:
    """A word in the alphabet of byte-level BPE, with U+0120 for the space before it."""
    lead, body = ("", word[1:]) if word[0] == "\n" else ("\u0120", word)
    return lead + (body if body.isascii() else body.encode().decode("latin-1").translate(_BYTES))


def _odd(word: str) -> bool:
    return not word or word == "\n" or word[word[0] == "\n"].isspace()


def _encode_letters(words: list[str], path: str) -> list[bytes]:
    """The ids of words of letters. Such a word, with the space before it, is what the tokenizer cuts out of a text, so it goes
    to the model as it is. The ids of all words come in one sequence, which is cut where the words' bytes end."""
    if not words:
        return []
    t, sizes = _bare(path)
    shown = list(map(_written, words))
    ids = np.array(t.encode_batch_fast([shown], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
    ends, wanted = np.cumsum(sizes[ids]), np.cumsum(list(map(len, shown)))
    cuts = np.searchsorted(ends, wanted)
    if len(ends) == 0 or cuts[-1] >= len(ends) or (ends[cuts] != wanted).any():
        return _whole([w if w[0] == "\n" else " " + w for w in words], path)
    data, cuts = ids.tobytes(), (4 * (cuts + 1)).tolist()
    (line,) = _whole(["\n"], path)
    return [line + data[a:b] if w[0] == "\n" else data[a:b] for w, a, b in zip(words, [0, *cuts], cuts)]


def _learn(words: set[str], path: str) -> dict[str, bytes]:
    """The ids of words, each with a space before it or, if it starts with one, a line break. They are remembered; when half of
    ``WORDS_KEPT`` are held, a new half begins, and words that are met again are taken over from the last one.

    Punctuation behind a letter or digit is a token run of its own, so it is encoded apart from its word, and only the word is
    remembered. Nor are odd words, so that :func:`encode_texts` meets them again.
    """
    if 2 * (len(_known) + len(words)) > WORDS_KEPT:
        _before.clear()
        _before.update(_known)
        _known.clear()
        _endings.clear()
    found = {w: _before[w] for w in _before.keys() & words}
    ended, bases, marked = {}, [], []
    for word in words.difference(found):
        (marked if word[-1:] in _PUNCTUATION else bases).append(word)
    for word in marked:
        base = word.rstrip(punctuation)
        if base and base[-1].isalnum():
            ended[word] = base, word[len(base) :]
        else:
            bases.append(word)
    for base in {b for b, _ in ended.values()}.difference(bases, found):
        ids = _known.get(base) or _before.get(base)
        if ids:
            found[base] = ids
        else:
            bases.append(base)
    letters = [w for w in bases if w.isalpha() or w[:1] == "\n" and w[1:].isalpha()]
    letters = [w for w in letters if w.isascii() or _LETTERS.fullmatch(w)]
    rest = list(set(bases).difference(letters)) if len(letters) < len(bases) else []
    found.update(zip(letters, _encode_letters(letters, path)))
    found.update(zip(rest, _whole([w if w[:1] == "\n" else " " + w for w in rest], path)))
    new = list({e for _, e in ended.values()}.difference(_endings))
    _endings.update(zip(new, _whole(new, path)))
    _known.update(found)
    for word in filter(_odd, rest):
        del _known[word]
    for word, (base, ending) in ended.items():
        found[word] = found[base] + _endings[ending]
    return found


def encode_texts(texts, path: str, end: bytes) -> list[bytes]:
    """The ids of each text and the end id, 4 bytes each; a null text counts as empty.

    Equal to encoding each whole text. Byte-level BPE never merges across the start of a word, and a space or line break after a
    character that is no white space starts one, as the last white space before other characters does; so a text is cut before
    its spaces and line breaks, and each distinct piece goes through the tokenizer once. Where a piece without anything behind
    its white space may belong to a longer run, the text is looked at; texts with such runs, or with a special token, are not cut.
    """
    special = [str(x.content) for x in tokenizer(path).get_added_tokens_decoder().values()]
    cuts, whole, cut, new, entire = _splits_at_spaces(path), {}, {}, set(), []
    for k, text in enumerate(texts):
        if not text:
            whole[k] = b""
            continue
        if not cuts or any(s in text for s in special):
            entire.append(k)
            continue
        head, *words = text.replace("\n", " \n").split(" ")
        parts = list(map(_known.get, words))
        if None in parts:
            gaps = [i for i, x in enumerate(parts) if x is None]
            lost = [words[i] for i in gaps]
            new.update(lost)
        else:
            gaps = lost = ()
        cut[k] = head, parts, gaps, lost
    if new:
        odd = set(filter(_odd, new)) if _ODD.search(" " + " ".join(new)) else set()
        for k in [k for k, c in cut.items() if not odd.isdisjoint(c[3]) and _JOINED.search(texts[k])] if odd else ():
            entire.append(k)
            del cut[k]
        found = _learn(new, path)
    heads = _whole([c[0] for c in cut.values()], path)
    for (k, (_, parts, gaps, lost)), first in zip(cut.items(), heads):
        for i, word in zip(gaps, lost):
            parts[i] = found[word]
        whole[k] = first + b"".join(parts)
    whole.update(zip(entire, _whole([texts[k] for k in entire], path)))
    return [whole[k] + end for k in range(len(whole))]


def encode_batches(batches, path: str, end_id: int = END_ID):
    """``(other columns, ids as bytes)`` of each row; the text is the last column of each Arrow batch."""
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            rows = zip(*[c.to_pylist() for c in part.columns[:-1]]) if part.num_columns > 1 else [()] * part.num_rows
            yield from zip(rows, encode_texts(part.columns[-1].to_pylist(), path, end))
