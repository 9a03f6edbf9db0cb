"""Settings documents on the driver: merging, environment values, paths, and dataclasses that ignore what they don't know."""

from __future__ import annotations

import dataclasses
import os
import re
import warnings
from collections.abc import Mapping
from typing import Any, TypeVar

T = TypeVar("T")
# Fixed value: how a settings document refers to the environment.
_REFERENCE = re.compile(r"\$\{(?P<name>[^}:]+)(?::-(?P<other>[^}]*))?\}")


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """`over` wins; mappings are merged at every depth, lists replaced. Neither argument is changed."""
    both = lambda a, b: merged(a, b) if isinstance(a, Mapping) and isinstance(b, Mapping) else b
    out = {k: merged(v, {}) if isinstance(v, Mapping) else v for k, v in base.items()}
    return out | {k: both(out.get(k), v) for k, v in over.items()}


def with_environment(value: Any, env: Mapping[str, str] | None = None) -> Any:
    """Strings at every depth with `${NAME}` and `${NAME:-other}` filled in; what has neither a value nor another stays as it is."""
    env = os.environ if env is None else env
    if isinstance(value, str):
        return _REFERENCE.sub(lambda m: env.get(m["name"], m["other"] if m["other"] is not None else m[0]), value)
    if isinstance(value, Mapping):
        return {k: with_environment(v, env) for k, v in value.items()}
    return [with_environment(v, env) for v in value] if isinstance(value, list) else value


def resolved_path(value: str, document: str, working: str) -> str:
    """`./` is of the working folder, `../` of the settings document's; other relative values with a slash and a suffix are of the working folder; anything else stays."""
    if value.startswith("../"):
        return os.path.normpath(os.path.join(os.path.dirname(document), value))
    bare = "/" in value and "://" not in value and not value.startswith(("/", "~")) and os.path.splitext(value)[1]
    return os.path.normpath(os.path.join(working, value)) if value.startswith("./") or bare else value


def section(kind: type[T], values: Mapping[str, Any], strict: bool = False) -> T:
    """The dataclass from the fields that it has; others are named in a warning, or in an error if `strict`."""
    names = {f.name for f in dataclasses.fields(kind)}
    if unknown := sorted(set(values) - names):
        said = f"{kind.__name__} has no {', '.join(unknown)}"
        if strict:
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    return kind(**{k: v for k, v in values.items() if k in names})
