from panelweave.functions.labels import (  # noqa: F401
    base_feature,
    null_if_nan,
    pair_key,
    result_name_parts,
    safe_name,
)
