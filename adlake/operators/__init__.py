"""Pure DataFrame-to-DataFrame steps: silver shaping, validation and gold metrics."""
