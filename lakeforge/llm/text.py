"""What counts as markup in a text."""

from __future__ import annotations

import re

#: A tag: a name after the bracket (or a slash), then attributes with values, or the attributes that take none.  Text
#: between two comparison signs is none.  Tags may be of any length.
TAG = (
    r"</?[A-Za-z][A-Za-z0-9:-]*(?:\s+(?:[A-Za-z_:@][\w:.-]*\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>]+)"
    r"|(?:disabled|checked|selected|hidden|required|readonly|multiple|nowrap|noshade|controls|autoplay|loop|muted|async|defer)\b))*\s*/?>"
)
_TAGS = re.compile(TAG, re.I)
_COMMENT = re.compile(r"<!--.*?-->", re.S)


def without_tags(text: str) -> str:
    """The text with a blank for each tag and comment."""
    if "<" not in text:
        return text
    end = text.rfind("-->")
    if end >= 0:  # beyond it no comment is closed
        text = _COMMENT.sub(" ", text[: end + 3]) + text[end + 3 :]
    return _TAGS.sub(" ", text)
