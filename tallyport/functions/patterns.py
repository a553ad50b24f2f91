"""Date and timestamp patterns, in the order in which they are tried (fixed values)."""

#: Each with the shape that a text must have before it is parsed: a failed parse costs an exception, a shape does not.
#: A month above 12 tells the European form with slashes from the American one.
DATE_PATTERNS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^(0?[1-9]|1[0-2])/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
)
#: Forms with the year first are left to a cast.
ISO_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?$"
TIMESTAMP_PATTERNS = (
    (r"^(0?[1-9]|1[0-2])/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "M/d/yyyy H:m:s"), (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "d-M-yyyy H:m:s"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "d/M/yyyy H:m:s"),
)
