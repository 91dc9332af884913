from florafold.functions.scalar import (  # noqa: F401
    parse_flag, media_type, file_name, version_name, version_date, is_null_id, id_kind,
    licence, days_between, folder, split_uri, id_list,
)
from florafold.functions.predicate import predicate_to_column  # noqa: F401
