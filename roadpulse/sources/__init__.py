"""Feed derivation, wire encode/decode, raw and refined storage, catalog tables."""
