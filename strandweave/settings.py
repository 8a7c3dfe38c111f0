"""Layered settings: defaults, then files, then named values; a later layer wins."""

from __future__ import annotations

import configparser
import os
from collections.abc import Callable, Mapping, Sequence


def layered(defaults: Mapping[str, str], files: Sequence[str] = (), values: Mapping[str, str] | None = None, checks: Mapping[str, Callable[[str], object]] | None = None) -> dict[str, object]:
    """The settings of all layers.

    ``files`` are ``key = value`` files in order (missing ones are skipped); ``checks``
    turn a setting's text into its value and raise ValueError for a bad one.  Keys
    that the defaults don't have are an error.
    """
    out: dict[str, object] = dict(defaults)
    layers: list[Mapping[str, str]] = []
    for path in files:
        if os.path.exists(path):
            parser = configparser.ConfigParser(interpolation=None, strict=False)
            parser.optionxform = str
            with open(path) as file:
                parser.read_string("[all]\n" + file.read())
            layers.append({k: v for section in parser.sections() for k, v in parser.items(section)})
    for layer in [*layers, values or {}]:
        unknown = sorted(set(layer) - set(defaults))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        out.update(layer)
    for key, check in (checks or {}).items():
        try:
            out[key] = check(str(out[key]))
        except (ValueError, KeyError) as e:
            raise ValueError(f"{key}: {e}") from e
    return out
