"""ledgerline.functions"""
