"""Column-expression builders."""
