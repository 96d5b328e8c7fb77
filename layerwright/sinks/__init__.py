from layerwright.sinks.files import landing_folder, write_landing_text, write_path_overwrite
from layerwright.sinks.tables import (
    create_if_absent,
    create_layers,
    load_dimension,
    load_fact,
    temp_view,
    truncate_reload,
    write_overwrite,
)

__all__ = [
    "create_if_absent",
    "create_layers",
    "landing_folder",
    "load_dimension",
    "load_fact",
    "temp_view",
    "truncate_reload",
    "write_landing_text",
    "write_overwrite",
    "write_path_overwrite",
]
