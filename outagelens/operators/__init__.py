"""DataFrame transforms built from the Column builders."""
