"""Inputs and independent answers for checking the warehouse; not part of the library."""
