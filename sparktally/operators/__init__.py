"""Generic DataFrame operators the analyses are composed of."""
