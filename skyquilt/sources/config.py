"""Settings of a job: defaults, rules, TOML."""

from __future__ import annotations

import copy
import inspect
import os
import tomllib
from collections.abc import Mapping
from datetime import datetime
from typing import Any

from ..functions.paths import FILTERS

# Defaults by dotted name.
DEFAULTS: dict[str, Any] = {
    "name": "skyquilt_run", "log_level": "INFO", "console_log_level": "WARNING", "source_catalogue": None, "output_dir": "cutouts", "output_format": "zarr",
    "data_type": "float32", "write_to_disk": True, "max_workers": os.cpu_count() or 16, "N_batch_cutout_process": 1000, "max_workflow_time_seconds": 1354571, "process_threads": None,
    "do_only_cutout_extraction": False, "target_resolution": 256, "padding_factor": 1.0, "normalisation_method": "linear", "interpolation": "bilinear", "flux_conserved_resizing": False,
    "fits_extensions": ["PRIMARY"], "selected_extensions": [], "available_extensions": [], "apply_flux_conversion": True, "flux_conversion_keywords": {"AB_zeropoint": "MAGZERO"}, "user_flux_conversion_function": None,
    "normalisation": {"a": None, "percentile": 99.8, "n_samples": 1000, "contrast": 0.25, "crop_enable": False, "crop_width": 64, "crop_height": 64}, "external_stretch": None, "channel_weights": {"PRIMARY": [1.0]},
    "tracking_file": "workflow_tracking.json", "config_file": None, "num_sources": 0, "fits_files": [], "num_unique_fits_files": 0, "memory_limit_gb": None,
    "loadbalancer": {"memory_safety_margin": 0.15, "memory_poll_interval": 3, "memory_peak_window": 30, "main_process_memory_reserve_gb": 4.0, "initial_workers": 1, "max_sources_per_process": None, "log_interval": 30, "event_log_file": None, "skip_memory_calibration_wait": False},
    "ui": {"preview_samples": 10, "preview_size": 256, "auto_regenerate_preview": True},
}

LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL", "TRACE"]
# Dotted name -> (type, least, most, may be None, allowed values).
RULES: dict[str, tuple] = {
    "name": (str, None, None, False, None),
    "log_level": (str, None, None, False, LEVELS),
    "console_log_level": (str, None, None, False, LEVELS),
    "output_dir": (str, None, None, False, None),
    "output_format": (str, None, None, False, ["zarr", "fits"]),
    "data_type": (str, None, None, False, ["float32", "uint8"]),
    "write_to_disk": (bool, None, None, False, None),
    "max_workers": (int, 1, 1024, False, None),
    "N_batch_cutout_process": (int, 10, 10000, False, None),
    "max_workflow_time_seconds": (int, 600, 5e6, False, None),
    "process_threads": (int, 1, 128, True, None),
    "do_only_cutout_extraction": (bool, None, None, False, None),
    "target_resolution": (int, 16, 2048, False, None),
    "padding_factor": (float, 0.25, 10.0, False, None),
    "normalisation_method": (str, None, None, False, ["linear", "log", "asinh", "zscale", "none"]),
    "interpolation": (str, None, None, False, ["bilinear", "nearest", "bicubic", "biquadratic"]),
    "flux_conserved_resizing": (bool, None, None, False, None),
    "fits_extensions": (list, None, None, False, None),
    "apply_flux_conversion": (bool, None, None, False, None),
    "flux_conversion_keywords.AB_zeropoint": (str, None, None, True, None),
    "normalisation.a": (float, 0.001, 10000.0, True, None),
    "normalisation.percentile": (float, 0.0, 100.0, True, None),
    "normalisation.n_samples": (int, 100, 10000, True, None),
    "normalisation.contrast": (float, 0.01, 1.0, True, None),
    "normalisation.crop_width": (int, 0, 5000, True, None),
    "normalisation.crop_height": (int, 0, 5000, True, None),
    "normalisation.crop_enable": (bool, None, None, True, None),
    "tracking_file": (str, None, None, False, None),
    "num_sources": (int, 0, None, True, None),
    "num_unique_fits_files": (int, 0, None, True, None),
    "memory_limit_gb": (float, 0.1, 1024.0, True, None),
    "loadbalancer.memory_safety_margin": (float, 0.01, 0.5, True, None),
    "loadbalancer.memory_poll_interval": (int, 1, 60, True, None),
    "loadbalancer.memory_peak_window": (int, 10, 300, True, None),
    "loadbalancer.main_process_memory_reserve_gb": (float, 0.5, 10.0, True, None),
    "loadbalancer.initial_workers": (int, 1, 8, True, None),
    "loadbalancer.max_sources_per_process": (int, 1, None, True, None),
    "loadbalancer.log_interval": (int, 5, 300, True, None),
    "loadbalancer.skip_memory_calibration_wait": (bool, None, None, True, None),
    "ui.preview_samples": (int, 1, 50, False, None),
    "ui.preview_size": (int, 16, 512, False, None),
    "ui.auto_regenerate_preview": (bool, None, None, False, None),
}


class ConfigError(ValueError):
    """Settings that break a rule; the message lists all of them."""


def default_config() -> dict[str, Any]:
    return copy.deepcopy(DEFAULTS) | {"session_timestamp": datetime.now().strftime("%Y%m%d_%H%M%S")}


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """base with the values of over; nested settings are merged, except channel weights, whose order and names are one value."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) and k != "channel_weights" else v
    return out


def create_config(values: Mapping[str, Any]) -> dict[str, Any]:
    return merged(default_config(), values)


def lookup(config: Mapping[str, Any], dotted: str) -> Any:
    for part in dotted.split("."):
        if not isinstance(config, Mapping) or part not in config:
            return None
        config = config[part]
    return config


def flat(config: Mapping[str, Any], prefix: str = "") -> dict[str, Any]:
    out: dict[str, Any] = {}
    for k, v in config.items():
        name = f"{prefix}{k}"
        if isinstance(v, Mapping) and k != "channel_weights":
            out |= flat(v, f"{name}.")
        else:
            out[name] = v
    return out


def unexpected(config: Mapping[str, Any]) -> list[str]:
    """Names without a rule or default: worth a warning, no error."""
    return sorted(set(flat(config)) - set(RULES) - set(flat(DEFAULTS)) - {"session_timestamp"})


def config_errors(config: Mapping[str, Any]) -> list[str]:
    out = []
    for name, (kind, low, high, optional, allowed) in RULES.items():
        v = lookup(config, name)
        if v is None:
            if not optional:
                out.append(f"{name} is missing")
            continue
        number = kind in (int, float)
        if isinstance(v, bool) and kind is not bool or not isinstance(v, (int, float) if kind is float else kind):
            out.append(f"{name} must be {kind.__name__}, not {type(v).__name__}")
        elif allowed is not None and v not in allowed:
            out.append(f"{name} must be one of {allowed}, not {v!r}")
        elif number and (low is not None and v < low or high is not None and v > high):
            out.append(f"{name} must lie in [{low}, {high}], not {v}")
    weights = config.get("channel_weights")
    if not isinstance(weights, Mapping) or not weights:
        out.append("channel_weights must map channels to lists of numbers")
    elif any(not isinstance(w, list) or not all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in w) for w in weights.values()):
        out.append("channel_weights must hold lists of numbers")
    elif len({len(w) for w in weights.values()}) != 1:
        out.append("channel_weights must have as many outputs for each channel")
    if config.get("do_only_cutout_extraction") and config.get("output_format") != "fits":
        out.append("raw cutouts need output_format fits")
    function = config.get("user_flux_conversion_function")
    if function is not None and (not callable(function) or len(inspect.signature(function).parameters) != 2):
        out.append("user_flux_conversion_function must take an image and a header")
    external = config.get("external_stretch")
    if external is not None and external.get("method") not in ("CONVERSION_ONLY", "LOG", "ZSCALE", "ASINH"):
        out.append(f"external stretch {external.get('method')!r} is not supported")
    return out


def validated(config: Mapping[str, Any]) -> Mapping[str, Any]:
    if errors := config_errors(config):
        raise ConfigError("; ".join(errors))
    return config


def validated_for_processing(config: Mapping[str, Any]) -> Mapping[str, Any]:
    """Also what a run needs: a catalogue, an output folder, selected extensions."""
    errors = config_errors(config) + [f"{k} is not set" for k in ("source_catalogue", "output_dir") if not config.get(k)]
    if not config.get("selected_extensions"):
        errors.append("selected_extensions is empty")
    if errors:
        raise ConfigError("; ".join(errors))
    return config


def extension_names(config: Mapping[str, Any]) -> list[str]:
    """Names of the selected extensions, PRIMARY if there are none; they come as names or as records with name and ext."""
    out = []
    for e in config.get("selected_extensions") or []:
        name = e.get("ext", e.get("name")) if isinstance(e, Mapping) else e
        out.append("PRIMARY" if name == "PrimaryHDU" else name)
    return out or ["PRIMARY"]


def _toml_value(v: Any) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(_toml_value, v)) + "]"
    if isinstance(v, Mapping):
        return "{" + ", ".join(f"{_toml_value(str(k))} = {_toml_value(x)}" for k, x in v.items() if x is not None) + "}"
    text = str(v).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
    return f'"{text}"'


def to_toml(config: Mapping[str, Any]) -> str:
    """Settings as TOML; None and functions are left out, types and enumeration members become tagged strings."""

    def plain(v: Any) -> Any:
        if isinstance(v, Mapping):
            return {k: plain(x) for k, x in v.items() if x is not None and not (callable(x) and not isinstance(x, type))}
        if isinstance(v, type):
            return f"__dtype__{v.__name__}"
        if hasattr(v, "value") and hasattr(type(v), "__members__"):
            return f"__enum__{type(v).__module__}.{type(v).__name__}__{v.value}"
        return v

    def table(c: Mapping[str, Any], head: str) -> str:
        top = [f"{_toml_value(str(k))} = {_toml_value(v)}\n" for k, v in c.items() if not isinstance(v, Mapping)]
        rest = [table(v, f"{head}.{_toml_value(str(k))}" if head else _toml_value(str(k))) for k, v in c.items() if isinstance(v, Mapping)]
        return (f"\n[{head}]\n" if head else "") + "".join(top) + "".join(rest)

    return table(plain(config), "")


def save_toml(config: Mapping[str, Any], path: str) -> str:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as f:
        f.write(to_toml(config))
    return path


def save_with_timestamp(config: Mapping[str, Any], folder: str) -> str:
    return save_toml(config, os.path.join(folder, f"skyquilt_config_{datetime.now():%Y%m%d_%H%M%S}.toml"))


def load_toml(path: str) -> dict[str, Any]:
    """Settings of a file over the defaults; tagged types and members come back."""
    import importlib

    def back(v: Any) -> Any:
        if isinstance(v, dict):
            return {k: back(x) for k, x in v.items()}
        if isinstance(v, str) and v.startswith("__dtype__"):
            import numpy as np

            return getattr(np, v[9:])
        if isinstance(v, str) and v.startswith("__enum__"):
            place, _, value = v[8:].rpartition("__")
            module, _, name = place.rpartition(".")
            kind = getattr(importlib.import_module(module), name)
            return next(m for m in kind if str(m.value) == value)
        return v

    with open(path, "rb") as f:
        return create_config(back(tomllib.load(f)))


BANDS = tuple(dict.fromkeys(band for _, band in FILTERS))
