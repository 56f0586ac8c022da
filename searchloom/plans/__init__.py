"""The composite jobs, from tables to finished results."""
