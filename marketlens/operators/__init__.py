"""DataFrame -> DataFrame operators.  Every function is lazy and works on all
instruments at once; none collects data to the driver."""
