"""Chunk stores, TIFF, geometry files, and blocks of voxels as rows."""
