"""Row and column operators (all lazy DataFrame -> DataFrame, built-in functions only)."""
