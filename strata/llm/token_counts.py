"""Token counts with a linear longest-match automaton.

The pieces of a public vocabulary form a trie. Greedy longest-match cutting of
a word would restart after each piece; here every trie node holds instead a
failure link (the node for what is left after the pieces that must be popped)
and the number of tokens popped on the way. A word is read once, character by
character, and its token count is a sum of precomputed numbers: no piece is
ever built.

Words are ``[^\\x20\\x09-\\x0D]+``. A word is matched with the vocabulary's
word-start mark before it. A character that no piece starts with on its own is
cut off alone and counts as many tokens as it has UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import longs, map_text, worker_cache

MARK = "▁"


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def automaton(pieces: list[str]) -> tuple[list[dict], list[int], list[int], list[int], list[int]]:
    """``(children, fail, popped, fallback)`` of the trie; node 0 is the root.

    ``popped[v]`` tokens, ``fallback[v]`` of them bytes, are final once no child of
    ``v`` fits the next character; matching goes on at ``fail[v]`` with that character.
    """
    children: list[dict] = [{}]
    weight = {}  # of nodes that end a piece: (tokens, bytes among them)
    chars = {c for p in pieces for c in p}
    for piece in [*pieces, *chars]:
        v = 0
        for c in piece:
            v = children[v].setdefault(c, len(children))
            if v == len(children):
                children.append({})
        weight[v] = (1, 0)
    for c in chars - set(pieces):
        n = len(c.encode())
        weight[children[0][c]] = (n, n)
    fail, popped, fallback = [0] * len(children), [0] * len(children), [0] * len(children)
    queue = [(0, c, v) for c, v in children[0].items()]
    for u, c, v in queue:  # breadth first: the parent's values are there
        if v in weight:
            popped[v], fallback[v] = weight[v]
        else:  # every character is a piece, so this ends at the root at the latest
            z, n, b = fail[u], popped[u], fallback[u]
            while c not in children[z]:
                n, b, z = n + popped[z], b + fallback[z], fail[z]
            fail[v], popped[v], fallback[v] = children[z][c], n, b
        queue += [(v, d, w) for d, w in children[v].items()]
    return children, fail, popped, fallback


def count_word(word: str, trie) -> tuple[int, int]:
    """(tokens, byte-fallback tokens) of the greedy longest-match cut of ``word``."""
    children, fail, popped, fallback = trie
    v = n = b = 0
    for c in word:
        while v and c not in children[v]:
            n, b, v = n + popped[v], b + fallback[v], fail[v]
        if (w := children[v].get(c)) is None:  # at the root: not a character of the vocabulary
            size = len(c.encode())
            n, b = n + size, b + size
        else:
            v = w
    while v:
        n, b, v = n + popped[v], b + fallback[v], fail[v]
    return n, b


def counter(path: str, cache_words: int = 200_000):
    """A function from texts to (words, tokens, fallback tokens); counts of frequent words are remembered."""
    trie = automaton(vocabulary(path))
    known: dict[bytes, int] = {}

    def count(texts: list[bytes]):
        out: tuple[list, list, list] = ([], [], [])
        for text in texts:
            words = text.split()  # bytes: ASCII white space, as the word pattern has it
            if len(known) > cache_words:
                known.clear()
            for w in {*words}.difference(known):
                n, b = count_word(MARK + w.decode("utf-8", "replace"), trie)
                known[w] = n << 32 | b
            both = sum(map(known.__getitem__, words))
            for o, x in zip(out, (len(words), both >> 32, both & 0xFFFFFFFF)):
                o.append(x)
        return out

    return count


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``n_words``, ``n_tokens``, ``n_fallback`` (tokens that stand for single bytes).

    Null and empty texts count 0; repeated rows are each counted; other columns
    are not read. One pass without a shuffle; memory is one batch of texts, the
    automaton and the word cache.
    """
    return map_text(docs, text_col, [id_col], longs("n_words", "n_tokens", "n_fallback"), lambda: worker_cache(("counts", path), lambda: counter(path)))
