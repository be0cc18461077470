"""DataFrame operators of the evidence pipeline. Rows carry an explicit ordinal (`_pos`) wherever "first" matters."""
