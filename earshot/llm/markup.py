"""What counts as markup in a text."""

from __future__ import annotations

import re

#: A tag or declaration of any length, with closing signs inside quoted values. No part is read twice, so the time is linear in the text.
TAG_PATTERN = r"""<[a-z/!?](?:=\s*+(?:"[^"<]*+"|'[^'<]*+')|[^<>])*+>"""
ENTITY_PATTERN = r"&(?:#[0-9]{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});"
TAG = re.compile(TAG_PATTERN, re.I)
