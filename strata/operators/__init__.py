"""DataFrame -> DataFrame operators, configured by the contracts module."""
