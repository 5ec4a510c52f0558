"""Campaign configuration: defaults, then an INI file, then what the caller gives."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Campaign:
    """Options that alter results; names and defaults as a survey office knows them."""

    dx: float = 0.5
    bin_half_width: float | None = None
    edge_extent: str = "mean"
    depth_ref: str = "auto"
    composite: bool = True
    bt_avg: str = "idw"
    bt_geometry: str = "footprints"
    vb_min: int = 1
    depth_filter: bool = True
    density_weighting: bool = True
    flow_weighting: str = "discharge"
    group_tol: float = 15.0
    group_angle_tol: float = 25.0
    group_max_span: float = 0.0
    ws_slope_min_span: float = 200.0
    ws_slope_max: float = 0.002
    ws_extrap_tol: float = 200.0
    ws_qc_tol: float = 0.10
    gps_max_gap: float = 0.30
    offset_scale: float = 3.0
    decimate: int = 1
    thin: float = 0.0
    beams: str = "all"
    locate_tol: float = 250.0
    offsets: dict[str, float] = field(default_factory=dict)
    groups: dict[str, list[str]] = field(default_factory=dict)
    rivers: dict[str, str] = field(default_factory=dict)
    warnings: tuple[str, ...] = ()

    @property
    def half_width(self) -> float:
        return 2 * self.dx if self.bin_half_width is None else self.bin_half_width


def _value(text: str, default):
    if isinstance(default, bool):
        return text.strip().lower() in ("1", "true", "yes", "on", "si", "sí")
    if isinstance(default, int) and not isinstance(default, bool):
        return int(text)
    if isinstance(default, float) or default is None:
        return float(text.replace(",", "."))
    return text.strip()


def load(path: str, **given) -> Campaign:
    """Read an INI file; unknown keys become warnings, and ``given`` options win."""
    parser = configparser.ConfigParser(interpolation=None)
    parser.optionxform = str
    parser.read(path, encoding="utf-8")
    known = {f.name: getattr(Campaign(), f.name) for f in fields(Campaign)}
    found, warnings = {}, []
    named = {"progresivas": "offsets", "grupos": "groups", "rios": "rivers"}
    for section in parser.sections():
        if section in named:
            turn = {"offsets": float, "groups": lambda v: [x for x in v.replace(";", ",").replace(",", " ").split() if x], "rivers": str.strip}[named[section]]
            found[named[section]] = {k: turn(v) for k, v in parser[section].items()}
        else:
            for key, text in parser[section].items():
                name = key.replace("-", "_").lower()
                if name in known and not isinstance(known[name], (dict, tuple)):
                    found[name] = _value(text, known[name])
                else:
                    warnings.append(f"[{section}] {key} is not known")
    return replace(Campaign(), **found | given, warnings=tuple(warnings))
