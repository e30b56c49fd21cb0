"""Static reading of program source: one pass to relations, everything else by joins over them."""
