"""Job parameters: dataclasses, loadable from ``key=value`` properties text."""

from __future__ import annotations

import dataclasses as dc
import datetime as _dt
from typing import Any


class ConfigError(ValueError):
    """A missing or malformed job parameter."""


def parse_properties(text: str) -> dict[str, str]:
    """Parse Java-style ``key=value`` lines; ``#``/``!`` comments; keys and
    values are stripped (a trailing blank in a key does not create a new key)."""
    out: dict[str, str] = {}
    for raw in text.splitlines():
        line = raw.strip()
        if not line or line[0] in "#!":
            continue
        for sep in ("=", ":"):
            if sep in line:
                k, v = line.split(sep, 1)
                out[k.strip()] = v.strip()
                break
        else:
            out[line] = ""
    return out


def load_properties(path: str) -> dict[str, str]:
    try:
        with open(path, encoding="utf-8") as fh:
            return parse_properties(fh.read())
    except FileNotFoundError as exc:
        raise ConfigError(f"config file not found: {path}") from exc


def _coerce(value: str, typ: Any):
    if typ in (int, "int"):
        return int(value)
    if typ in (float, "float"):
        return float(value)
    if typ in (bool, "bool"):
        v = value.lower()
        if v not in ("true", "false"):
            raise ConfigError(f"not a boolean: {value!r}")
        return v == "true"
    return value


def from_properties(cls, props: dict[str, str], keys: dict[str, str]):
    """Build dataclass ``cls`` from ``props`` using ``keys``: field -> property key."""
    kwargs = {}
    fields = {f.name: f for f in dc.fields(cls)}
    for field, key in keys.items():
        if key in props:
            try:
                kwargs[field] = _coerce(props[key], fields[field].type)
            except ValueError as exc:
                raise ConfigError(f"{key}: {exc}") from exc
    return cls(**kwargs)


@dc.dataclass(frozen=True)
class GeneratorConfig:
    """Shape of the generated records (the 9-column main schema).

    Fixed values: the defaults below (counts 5, 2, 5, 3, 2; text lengths 12
    and 30; code range 500; 20 partitions; dates 2018-01-01 to 2020-01-01)
    are those of the original generator's configuration.  The seed is ours.
    """

    seed: int = 42
    initial_count: int = 5        # c1
    inner_iterations1: int = 2    # i1
    outer_iterations1: int = 5    # o1
    inner_iterations2: int = 3    # i2
    outer_iterations2: int = 2    # o2
    address_len: int = 12
    accname_len: int = 30
    code_range: int = 500
    partitions: int = 20          # PARTITIONER values '0'..'partitions-1'
    start: _dt.date = _dt.date(2018, 1, 1)
    end: _dt.date = _dt.date(2020, 1, 1)   # excluded

    def record_count(self) -> int:
        """c1 * i1^o1 * i2^o2 (5 * 2^5 * 3^2 = 1440 by default)."""
        return (self.initial_count * self.inner_iterations1 ** self.outer_iterations1
                * self.inner_iterations2 ** self.outer_iterations2)

    @classmethod
    def from_properties(cls, props: dict[str, str]) -> "GeneratorConfig":
        # The property keys of the original generator config.
        cfg = from_properties(cls, props, {
            "initial_count": "initial.record.count1",
            "inner_iterations1": "inner.iterations1",
            "outer_iterations1": "outer.iterations1",
            "inner_iterations2": "inner.iterations2",
            "outer_iterations2": "outer.iterations2",
            "address_len": "address.string.len",
            "accname_len": "accname.int.len",
            "partitions": "file.partitions.number",
        })
        try:
            start = _dt.date(int(props.get("start.year", cfg.start.year)),
                             int(props.get("start.month", cfg.start.month)),
                             int(props.get("start.day", cfg.start.day)))
            end = _dt.date(int(props.get("end.year", cfg.end.year)),
                           int(props.get("end.month", cfg.end.month)),
                           int(props.get("end.day", cfg.end.day)))
        except ValueError as exc:
            raise ConfigError(f"bad date: {exc}") from exc
        return dc.replace(cfg, start=start, end=end)
