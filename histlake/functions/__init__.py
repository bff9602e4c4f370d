"""Column-level helpers (pure ``Column -> Column`` expressions, JVM-side)."""

from histlake.functions.text import (extract_update_date, file_name_from_header,  # noqa: F401
                                     list_items, normalise_name, select_options,
                                     unescape_html, url_quote)
