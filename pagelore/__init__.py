"""pagelore: page texts to normalised sentences and entities, planned by Catalyst."""

__version__ = "0.1.0"
