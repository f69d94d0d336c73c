"""Settings of a run: known keys with their defaults, checked types and ranges. Thresholds enter plans as literals."""

from __future__ import annotations

import copy
import json
import math
import os
from typing import Any

from tessera.operators import quality, special, terrain

# The keys of a settings file and their defaults. None stands for an optional text or list.
DEFAULTS: dict[str, Any] = {
    "input": {
        "domain": "", "domain_layer": None, "domain_min_area": 1000.0, "polygon_filter": None, "dem": "",
        "breaklines": dict.fromkeys(("levees", "embankments", "riverbanks", "channels", "roads", "other")),
        "special_edges": {"file": None, "default_kind": "ROAD", "match_tol": 0.0, "default_fr": 0.0, "field_kind": "kind", "field_zc": "zc", "field_H": "H", "field_z_road": "z_road", "field_B": "B", "field_cover": "cover", "field_qgroup": "qgroup", "field_z_mode": "z_mode", "field_fr": "fr", "z_mode": "absolute"},
        "reference_layers": dict.fromkeys(("osm_roads", "osm_buildings", "other")),
    },
    "crs": {"target_epsg": 6670},
    "mesh": {
        "min_element_area": 625.0, "global_min_size": 45.0, "global_max_size": 150.0,
        "boundary_quad_band": {"enabled": False, "method": "transfinite", "width": 30.0, "target_size": 50.0, "layers": 1, "interface_size": 0.0, "interface_floor_radius": 0.0, "min_width_ratio": 0.25, "max_shrink_passes": 12, "corner_angle_deg": 120.0, "max_corner_cut": 0.0},
        "interior_quads": {"enabled": False, "mode": "selective", "target_regions": ["flat"], "flatness_plane_fit_rmse_max": 0.05, "recombination_algorithm": 3, "revert_to_triangles_if_nonconvex": True},
        "breakline_processing": {"min_vertex_spacing": 0.0, "simplify_tolerance": 1.0, "min_length": 0.0, "interior_margin": 0.0, "min_clearance": 0.0, "size_floor": 0.0},
        "road_target_size": 45.0, "levee_target_size": 45.0, "transition_distance": 100.0, "max_iterations": 8, "refinement_factor": 0.7, "max_neighbor_size_ratio": 1.5, "max_neighbor_element_ratio": 2.0, "size_field_grid": 40.0, "max_refine_attempts": 3, "narrow_feature_radius": 0.0, "triangles_only": False,
    },
    "terrain": {"plane_fit_rmse_max": 0.10, "slope_direction_spread_max_deg": 25.0, "representative_elevation_method": "area_weighted_mean", "minimum_dem_samples_per_element": 4, "refine_if_insufficient_dem_samples": True, "flat_slope_threshold": 0.01, "dem_target_px_m": 0.0},
    "quality": {"triangle_min_angle_deg": 25.0, "triangle_radius_ratio_min": 0.30, "triangle_aspect_ratio_max": 4.0, "quadrilateral_aspect_ratio_max": 3.0, "quadrilateral_min_interior_angle_deg": 20.0, "quadrilateral_max_interior_angle_deg": 160.0, "quadrilateral_scaled_jacobian_min": 0.30, "allow_local_exception_near_constraints": False},
    "features": {"breaklines_as_mesh_edges": True, "split_surface_by_breaklines": True, "create_quad_band_along_roads": False, "create_quad_band_along_levees": False, "reference_layers_for_size_field": False, "reference_layers_in_diagnostics": True},
    "gmsh": {"algorithm_2d": 6, "optimize": True, "optimization_method": "Laplace2D", "save_all": True, "verbosity": 0, "num_threads": 1},
    "output": {
        "directory": "output", "basename": "mesh", "default_fr": 0.35, "save_diagnostics": True, "save_iteration_meshes": True, "write_vtu": True, "write_xdmf": True, "write_msh": True,
        "gpkg_csv": {"enabled": True, "directory": "output_gpkg_csv", "face_gpkg": "face.gpkg", "edge_gpkg": "edge.gpkg", "face_csv": "face.csv", "edge_csv": "edge.csv"},
        "cell_bin": {"enabled": False, "directory": None, "filename": "", "landuse_raster": None, "landuse_epsg": None, "soil_raster": None, "soil_epsg": None, "buildings": None, "building_ratio_max": 0.95, "vegetation": None, "vegetation_ratio_max": 0.95, "veg_field_cd": "Cd", "veg_field_a": "a", "veg_field_hv": "Hv", "lts": {"enabled": True, "max_level": 2, "binning": "quantile"}, "index_order": "original"},
    },
    "parallel": {"enabled": False, "workers": 4, "min_block_area_m2": None, "keep_block_outputs": True},
}
WHOLE = {"landuse_epsg", "soil_epsg"}
NUMBERS = {"min_block_area_m2"}
LISTS = {"polygon_filter"}
NOT_METRIC = {3857, 900913, 4326, 4612, 6668, 6697}


class SettingsError(ValueError):
    """An unknown key, a value of the wrong type, or one out of range."""


def merged(known: dict[str, Any], given: Any, path: str = "") -> dict[str, Any]:
    """known with the given values in it; unknown keys and other types are errors."""
    if given is None:
        given = {}
    if not isinstance(given, dict):
        raise SettingsError(f"{path or 'settings'}: a mapping is needed")
    if strange := sorted(set(given) - set(known)):
        raise SettingsError(f"{path or 'settings'}: unknown keys {strange}")
    out = copy.deepcopy(known)
    for k, v in given.items():
        out[k] = checked(k, known[k], v, f"{path}.{k}" if path else k)
    return out


def checked(key: str, usual: Any, value: Any, path: str) -> Any:
    if isinstance(usual, dict):
        return merged(usual, value, path)
    if value is None and (usual is None or isinstance(usual, list)):
        return None
    whole, number = isinstance(value, int) and not isinstance(value, bool), isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(usual, bool):
        ok = isinstance(value, bool)
    elif isinstance(usual, float) or key in NUMBERS:
        ok, value = number, float(value) if number else value
    elif isinstance(usual, int) or key in WHOLE:
        ok = whole
    elif isinstance(usual, list) or key in LISTS:
        ok = isinstance(value, list)
    else:
        ok = isinstance(value, str)
    if not ok:
        raise SettingsError(f"{path}: {value!r} is of the wrong type")
    return value


class Settings:
    """A checked set of settings; s["mesh"]["min_element_area"]."""

    def __init__(self, given: dict[str, Any] | None = None, base: str = "."):
        self.values, self.base = merged(DEFAULTS, given), os.path.abspath(base)
        self._check()

    def __getitem__(self, name: str) -> dict[str, Any]:
        return self.values[name]

    def resolve(self, path: str | None) -> str | None:
        """A path of the settings file, which is relative to its folder."""
        if not path:
            return None
        return path if "://" in path or os.path.isabs(path) else os.path.normpath(os.path.join(self.base, path))

    # derived values

    def spacing(self) -> float:
        return self["mesh"]["breakline_processing"]["min_vertex_spacing"] or self["mesh"]["global_min_size"]

    def least_length(self) -> float:
        return self["mesh"]["breakline_processing"]["min_length"] or 2 * self.spacing()

    def clearance(self) -> float:
        return self["mesh"]["breakline_processing"]["min_clearance"] or 2 * self["mesh"]["min_element_area"] / self.spacing()

    def line_floor(self) -> float:
        m = self["mesh"]
        return m["breakline_processing"]["size_floor"] or max(m["global_min_size"], 1.1 * math.sqrt(m["min_element_area"] / 0.29))

    def margin(self) -> float:
        band = self["mesh"]["boundary_quad_band"]
        return self["mesh"]["breakline_processing"]["interior_margin"] or (band["width"] if band["enabled"] else self.spacing() / 2)

    def interface(self) -> tuple[float, float]:
        """(size, reach) of the raised floor along the band's inner side."""
        band = self["mesh"]["boundary_quad_band"]
        return band["interface_size"] or 1.5 * band["target_size"], band["interface_floor_radius"] or self["mesh"]["size_field_grid"]

    def narrow_radius(self) -> float:
        m = self["mesh"]
        band = m["boundary_quad_band"]
        return m["narrow_feature_radius"] or (band["width"] * band["min_width_ratio"] * 1.05 if band["enabled"] else 0.0)

    def match_tolerance(self) -> float:
        return self["input"]["special_edges"]["match_tol"] or max(1.0, 0.05 * self["mesh"]["global_min_size"])

    def shape(self) -> quality.Limits:
        m, q = self["mesh"], self["quality"]
        return quality.Limits(m["min_element_area"], q["triangle_min_angle_deg"], q["triangle_radius_ratio_min"], q["triangle_aspect_ratio_max"], q["quadrilateral_min_interior_angle_deg"], q["quadrilateral_max_interior_angle_deg"], q["quadrilateral_aspect_ratio_max"], q["quadrilateral_scaled_jacobian_min"], m["max_neighbor_element_ratio"] or math.inf)

    def ground(self) -> terrain.Limits:
        t = self["terrain"]
        return terrain.Limits(t["plane_fit_rmse_max"], t["slope_direction_spread_max_deg"], t["flat_slope_threshold"], t["minimum_dem_samples_per_element"] if t["refine_if_insufficient_dem_samples"] else 0)

    def block(self, index: int, folder: str) -> Settings:
        """The settings of one block: its polygon alone, its own folders."""
        out = copy.deepcopy(self)
        out["input"]["polygon_filter"] = [index]
        out["output"]["directory"] = f"{folder}/block_{index:03d}"
        out["output"]["gpkg_csv"]["directory"] = f"{folder}/block_{index:03d}"
        return out

    def _check(self) -> None:
        m, q, t, o, se = self["mesh"], self["quality"], self["terrain"], self["output"], self["input"]["special_edges"]
        band, inner, cells = m["boundary_quad_band"], m["interior_quads"], o["cell_bin"]
        try:
            kind = special.parse_kind(se["default_kind"])
            se["default_kind"] = next(n for n, k in special.KINDS.items() if k == kind)
            se["z_mode"] = special.z_mode_of(se["z_mode"], "absolute")
        except special.SpellingError as e:
            raise SettingsError(f"input.special_edges: {e}") from e
        rules = (
            (self["crs"]["target_epsg"] not in NOT_METRIC, "crs.target_epsg isn't a metric system"),
            (self["input"]["domain"], "input.domain is missing"), (self["input"]["dem"], "input.dem is missing"),
            (m["min_element_area"] > 0, "mesh.min_element_area must be positive"), (m["global_min_size"] < m["global_max_size"], "mesh.global_min_size must be below global_max_size"),
            (0 < m["refinement_factor"] < 1, "mesh.refinement_factor must be between 0 and 1"), (m["max_neighbor_size_ratio"] > 1, "mesh.max_neighbor_size_ratio must be above 1"),
            (m["max_neighbor_element_ratio"] == 0 or m["max_neighbor_element_ratio"] > 1, "mesh.max_neighbor_element_ratio must be 0 or above 1"),
            (m["global_min_size"] >= math.sqrt(4 * m["min_element_area"] / math.sqrt(3)), "mesh.global_min_size is below the side of a triangle of min_element_area"),
            (not band["enabled"] or band["method"] in ("transfinite", "boundary_layer"), "mesh.boundary_quad_band.method is unknown"),
            (not band["enabled"] or band["width"] * band["target_size"] >= m["min_element_area"], "mesh.boundary_quad_band's cells are below min_element_area"),
            (not band["enabled"] or band["layers"] >= 1, "mesh.boundary_quad_band.layers must be 1 or more"),
            (inner["mode"] in ("none", "selective", "opportunistic"), "mesh.interior_quads.mode is unknown"), (inner["recombination_algorithm"] in (0, 1, 2, 3), "mesh.interior_quads.recombination_algorithm is unknown"),
            (t["representative_elevation_method"] in ("area_weighted_mean", "median", "centroid_sample", "fitted_plane_at_centroid"), "terrain.representative_elevation_method is unknown"),
            (t["minimum_dem_samples_per_element"] >= 1, "terrain.minimum_dem_samples_per_element must be 1 or more"),
            (0 < q["triangle_radius_ratio_min"] <= 1, "quality.triangle_radius_ratio_min must be above 0 and at most 1"),
            (q["quadrilateral_min_interior_angle_deg"] < q["quadrilateral_max_interior_angle_deg"], "quality's angles of quads contradict each other"),
            (cells["index_order"] in ("original", "rcm"), "output.cell_bin.index_order is unknown"),
            (not cells["lts"]["enabled"] or cells["lts"]["max_level"] >= 0, "output.cell_bin.lts.max_level must be 0 or more"), (not cells["lts"]["enabled"] or cells["lts"]["binning"] in ("log", "linear", "quantile"), "output.cell_bin.lts.binning is unknown"),
            (0 < cells["building_ratio_max"] <= 1, "output.cell_bin.building_ratio_max must be above 0 and at most 1"), (0 < cells["vegetation_ratio_max"] <= 1, "output.cell_bin.vegetation_ratio_max must be above 0 and at most 1"),
            (all(cells[k].strip() for k in ("veg_field_cd", "veg_field_a", "veg_field_hv")), "output.cell_bin's vegetation fields need names"),
            (se["match_tol"] >= 0, "input.special_edges.match_tol must be 0 or more"), (se["default_kind"] != "NONE", "input.special_edges.default_kind can't be NONE"),
            (0 <= se["default_fr"] <= 1, "input.special_edges.default_fr must be between 0 and 1"), (0 <= o["default_fr"] <= 1, "output.default_fr must be between 0 and 1"),
            (all(v.strip() for k, v in se.items() if k.startswith("field_")), "input.special_edges' fields need names"),
        )
        if wrong := [text for ok, text in rules if not ok]:
            raise SettingsError("; ".join(wrong))


def load(path: str) -> Settings:
    """Settings of a YAML file (if a parser is there) or a JSON file."""
    if not os.path.isfile(path):
        raise SettingsError(f"no settings at {path}")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        given = yaml.safe_load(text)
    except ImportError:
        given = json.loads(text or "{}")
    return Settings(given or {}, os.path.dirname(os.path.abspath(path)))
