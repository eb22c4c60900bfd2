"""Settings: declared keys with types and defaults, read from a file and the environment."""

from __future__ import annotations

import os
import stat
from collections.abc import Mapping
from dataclasses import dataclass

from spanlake.functions.names import SECRET_PARTS


class SettingsError(Exception):
    """A setting is missing, unreadable or unsafe. The text never holds a secret."""


@dataclass(frozen=True)
class Setting:
    """A key with its type, default, help, and whether it is secret."""

    key: str
    kind: type = str
    default: object = None
    help: str = ""
    secret: bool = False


DECLARED = (
    Setting("SPANLAKE_SOURCE", help="kind of source", default="files"),
    Setting("SPANLAKE_SOURCE_FOLDER", help="folder of observations, scores and resources"),
    Setting("SPANLAKE_SOURCE_FORM", help="parquet, json or orc", default="parquet"),
    Setting("SPANLAKE_TARGET", help="folder of spans, score cells and the ledger"),
    Setting("SPANLAKE_PROJECT", help="name of the project that spans go to"),
    Setting("SPANLAKE_PATH", help="auto, bulk or quick", default="auto"),
    Setting("SPANLAKE_BATCH_ROWS", int, 10_000, "spans in a batch"),
    Setting("SPANLAKE_BATCH_BYTES", int, 32 << 20, "bytes in a batch"),
    Setting("SPANLAKE_YEARS", int, 2, "years of history"),
    Setting("SPANLAKE_MAX_DAYS", int, None, "days in one run, oldest first"),
    Setting("SPANLAKE_OVERWRITE", bool, False, "replace days that are there"),
    Setting("SPANLAKE_REATTACH_ORPHANS", bool, False, "hang spans with a lost parent on the root"),
    Setting("SPANLAKE_DESTINATION", help="folder that batches, annotations and updates go to"),
    Setting("SPANLAKE_VERIFY_SECONDS", int, 600, "patience until all spans can be read back"),
    Setting("SPANLAKE_INTEGRATIONS", help="integrations of evaluators by provider, as a=x,b=y"),
    Setting("SPANLAKE_DEFAULT_INTEGRATION", help="integration of other providers"),
    Setting("SPANLAKE_DEFAULT_MODEL", help="model of evaluators without one"),
    Setting("SPANLAKE_CODE_FOLDER", help="folder that code evaluators are written to"),
    Setting("SPANLAKE_CREATE_TASKS", bool, False, "make tasks of rules, which cost money"),
    Setting("SPANLAKE_API_KEY", help="key that a sender uses", secret=True),
)


def is_secret(key: str) -> bool:
    """Secret by declaration, or by its name."""
    return any(s.key == key and s.secret for s in DECLARED) or any(part in key.upper() for part in SECRET_PARTS)


def redact(value: str | None, keep: int = 4) -> str:
    return f"{value[:keep]}…<{len(value)} chars>" if value else "<unset>"


def value_of(raw: str) -> str:
    """A value of a settings file: quotes are taken off; without quotes a comment after white space ends it."""
    raw = raw.strip()
    if raw[:1] in ("'", '"'):
        end = raw.find(raw[0], 1)
        return raw[1:end] if end > 0 else raw[1:]
    for i, c in enumerate(raw):
        if c == "#" and (i == 0 or raw[i - 1].isspace()):
            return raw[:i].strip()
    return raw


def parse_file(path: str) -> dict[str, str]:
    """KEY=value lines; blank lines and comments are passed over, `export` is allowed."""
    out = {}
    with open(path) as lines:
        for line in lines:
            line = line.strip().removeprefix("export ")
            if line and not line.startswith("#") and "=" in line:
                key, raw = line.split("=", 1)
                out[key.strip()] = value_of(raw)
    return out


class Settings:
    """Values by key: the file goes before the environment, and that before defaults."""

    def __init__(self, values: Mapping[str, str]):
        self.given = dict(values)
        self.declared = {s.key: s for s in DECLARED}
        self.warnings = [f"unknown setting {k}" for k in sorted(self.given) if k.startswith("SPANLAKE_") and k not in self.declared]

    def get(self, key: str):
        """The value in its type, or the default."""
        setting = self.declared.get(key, Setting(key))
        raw = self.given.get(key)
        if raw in (None, ""):
            return setting.default
        try:
            return raw.strip().lower() in ("1", "true", "yes", "on") if setting.kind is bool else setting.kind(raw)
        except ValueError:
            raise SettingsError(f"{key} is no {setting.kind.__name__}") from None

    def require(self, *keys: str) -> list:
        """Values that were given; a default doesn't count."""
        missing = [k for k in keys if not self.given.get(k)]
        if missing:
            raise SettingsError("missing: " + ", ".join(missing))
        return [self.get(k) for k in keys]

    def summary(self) -> dict[str, str]:
        """All given values with secrets redacted."""
        return {k: redact(v) if is_secret(k) else v for k, v in sorted(self.given.items()) if k in self.declared}


def load(path: str | None = None, environment: Mapping[str, str] | None = None, owner_only: bool = True) -> Settings:
    """Settings from the environment and a file; a file that others can read is refused."""
    env = os.environ if environment is None else environment
    values = {k: v for k, v in env.items() if k.startswith("SPANLAKE_")}
    if path:
        if owner_only and stat.S_IMODE(os.stat(path).st_mode) & 0o077:
            raise SettingsError(f"{path} can be read by others; chmod 600 it")
        values |= parse_file(path)
    return Settings(values)


def template() -> str:
    """A settings file with every key, its help and its default."""
    return "\n".join(f"# {s.help}{'' if s.default is None else f' (default {s.default})'}\n# {s.key}=\n" for s in DECLARED)
