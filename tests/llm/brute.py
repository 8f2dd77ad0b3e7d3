"""Definitions that the operators are held to, in plain Python."""

import re


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))


def without_passages(texts, length=50):
    """Texts by rank without each passage of `length` words that stands earlier, by definition."""
    seen, want = set(), {}
    for doc_id, text in sorted(texts.items()):
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        low, gone = words(text), set()
        for k in range(len(low) - length + 1):
            passage = tuple(low[k : k + length])
            if passage in seen:
                gone |= set(range(k, k + length))
            seen.add(passage)
        kept = "".join(
            text[end:start] + (text[start:stop] if k not in gone else "\0")
            for k, ((_, end), (start, stop)) in enumerate(zip([(0, 0), *spans], spans))
        )
        # white space between two removed words goes with them
        want[doc_id] = re.sub(r"\0[\x20\x09-\x0D\0]*\0|\0", "", kept + text[spans[-1][1] if spans else 0 :])
    return want
