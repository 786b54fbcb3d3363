"""Column expressions used by the operators."""

from shiplog.functions.paths import (
    base_name,
    depth,
    is_noise,
    last_folder,
    normalise_path,
    package_comment,
    package_stamp,
    parent_folder,
)
from shiplog.functions.predicates import (
    DEFAULT_TECH,
    MASK,
    default_if_blank,
    in_csv_list,
    is_secret,
    lnnvl,
    override_key,
    override_value,
    shown_value,
    split_override,
    valid_app_id,
    valid_override,
)
from shiplog.functions.text import (
    ambiguous,
    enclose,
    enclosed_expr,
    enclosed_parts,
    enclosed_record,
    field_at,
    render_text,
    split_enclosed,
)

__all__ = [
    "DEFAULT_TECH",
    "MASK",
    "ambiguous",
    "base_name",
    "default_if_blank",
    "depth",
    "enclose",
    "enclosed_expr",
    "enclosed_parts",
    "enclosed_record",
    "field_at",
    "in_csv_list",
    "is_noise",
    "is_secret",
    "last_folder",
    "lnnvl",
    "normalise_path",
    "override_key",
    "override_value",
    "package_comment",
    "package_stamp",
    "parent_folder",
    "render_text",
    "shown_value",
    "split_enclosed",
    "split_override",
    "valid_app_id",
    "valid_override",
]
